"""SQL of the registered queries for an independent engine on the same tables.

Doubles are rounded as in the queries: to six places after a small nudge, so that
a value that ends exactly half way goes the same way on both sides.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

# --- shared relations -----------------------------------------------------------

RAW = """
lines AS (
  SELECT l_suppkey, l_linestatus AS property_type, l_extendedprice AS price,
         l_quantity AS qty, l_discount AS disc, l_returnflag AS rf,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS ship
  FROM lineitem),
spans AS (
  SELECT l.*, CAST(ship + to_months(k - 2) AS DATE) AS period_begin,
         last_day(CAST(ship + to_months(k) AS DATE)) AS period_end
  FROM lines l CROSS JOIN (VALUES (0), (1), (2)) AS o(k)
  UNION ALL
  SELECT l.*, ship, last_day(ship) FROM lines l WHERE year(ship) = 1996),
cells AS (
  SELECT l_suppkey, property_type, period_begin, period_end,
         median(price) AS median_sale_price, CAST(count(*) AS DOUBLE) AS homes_sold,
         sum(qty) AS inventory,
         CAST(count(*) FILTER (WHERE rf = 'N') AS DOUBLE) AS new_listings,
         median(qty) AS median_dom, avg(1 - disc) AS avg_sale_to_list,
         avg(CASE WHEN disc = 0 THEN 1.0 ELSE 0.0 END) AS sold_above_list
  FROM spans
  WHERE date_trunc('month', period_end) BETWEEN
    (SELECT min(ship) + INTERVAL 2 MONTH FROM lines) AND
    (SELECT date_trunc('month', CAST(max(l_shipdate) AS DATE) + 1) - INTERVAL 1 MONTH FROM lineitem)
  GROUP BY ALL),
kept AS (
  SELECT * FROM cells
  WHERE NOT (date_trunc('month', period_end) = DATE '1998-04-01' AND l_suppkey % 7 = 0)),
tracker AS (
  SELECT 'Zip Code: ' || l_suppkey AS region_zip, * FROM kept
  UNION ALL
  SELECT 'Zip Code: ' || l_suppkey, * REPLACE (median_sale_price + 1 AS median_sale_price)
  FROM kept WHERE date_trunc('month', period_end) = DATE '1997-06-01'
  UNION ALL
  SELECT 'Zip Code: unknown', * FROM kept
  WHERE date_trunc('month', period_end) = DATE '1996-09-01' AND l_suppkey % 11 = 0
  UNION ALL
  SELECT 'Zip Code: ' || l_suppkey, * REPLACE (CAST(NULL AS DOUBLE) AS median_sale_price)
  FROM kept WHERE date_trunc('month', period_end) = DATE '1997-11-01' AND l_suppkey % 13 = 0)"""

TIDY = RAW + """,
windowed AS (
  SELECT *, CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 5
                 THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0')
                 ELSE CAST(l_suppkey AS VARCHAR) END AS zip,
         CAST(date_trunc('month', period_end) AS DATE) AS month
  FROM tracker
  WHERE property_type = 'O' AND day(period_begin) = 1
    AND period_end = last_day(CAST(period_begin + INTERVAL 2 MONTH AS DATE))),
keyed AS (SELECT * FROM windowed WHERE regexp_matches(region_zip, '[0-9]\\s*$')),
priced AS (SELECT * FROM keyed WHERE median_sale_price IS NOT NULL),
tidy AS (
  SELECT zip, month, median_sale_price, homes_sold, inventory, new_listings, median_dom,
         avg_sale_to_list, sold_above_list, homes_sold < 10 AS low_volume
  FROM priced
  QUALIFY row_number() OVER (
    PARTITION BY zip, month
    ORDER BY period_end DESC NULLS FIRST, median_sale_price DESC NULLS FIRST,
             homes_sold DESC NULLS FIRST, inventory DESC NULLS FIRST) = 1)"""

INDEX = """
home_index AS (
  SELECT CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 5
              THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0')
              ELSE CAST(l_suppkey AS VARCHAR) END AS zip,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         avg(l_extendedprice / l_quantity) AS zhvi
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE s_acctbal > 1000 GROUP BY ALL)"""

MACRO = """
weekly AS (
  SELECT CASE WHEN o_orderpriority LIKE '4%' THEN '5-LOW' ELSE o_orderpriority END AS prio,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS wk, avg(o_totalprice) / 10000 AS v
  FROM orders GROUP BY ALL),
monthly AS (
  SELECT prio, CAST(date_trunc('month', wk) AS DATE) AS month, avg(v) AS v
  FROM weekly
  WHERE NOT (prio = '2-HIGH' AND date_trunc('month', wk) = DATE '1999-10-01')
  GROUP BY ALL),
macro_raw AS (
  SELECT month, max(v) FILTER (WHERE prio = '1-URGENT') AS MORTGAGE30US,
         max(v) FILTER (WHERE prio = '2-HIGH') AS UNRATE,
         max(v) FILTER (WHERE prio = '3-MEDIUM') AS CPIAUCSL,
         max(v) FILTER (WHERE prio = '5-LOW') AS HOUST
  FROM monthly WHERE prio IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
  GROUP BY month)""" + "".join(
    f""",
fill_{s} AS (
  SELECT a.month, (SELECT b.{s} FROM macro_raw b
                   WHERE b.month <= a.month AND b.{s} IS NOT NULL
                   ORDER BY b.month DESC LIMIT 1) AS {s}
  FROM macro_raw a
  WHERE a.month <= (SELECT max(month) FROM macro_raw WHERE {s} IS NOT NULL))"""
    for s in ("MORTGAGE30US", "UNRATE", "CPIAUCSL", "HOUST")
) + """,
macro AS (
  SELECT m.month, f1.MORTGAGE30US, f2.UNRATE, f3.CPIAUCSL, f4.HOUST
  FROM macro_raw m LEFT JOIN fill_MORTGAGE30US f1 ON f1.month = m.month
  LEFT JOIN fill_UNRATE f2 ON f2.month = m.month
  LEFT JOIN fill_CPIAUCSL f3 ON f3.month = m.month
  LEFT JOIN fill_HOUST f4 ON f4.month = m.month)"""

PANEL = TIDY + "," + INDEX + "," + MACRO + """,
panel AS (
  SELECT t.*, i.zhvi, m.MORTGAGE30US, m.UNRATE, m.CPIAUCSL, m.HOUST
  FROM tidy t JOIN home_index i ON i.zip = t.zip AND i.month = t.month
  LEFT JOIN macro m ON m.month = t.month)"""

_LAGS = (1, 3, 6, 12)
FEATURES = PANEL + """,
base AS (
  SELECT p.*, """ + ", ".join(
    f"p.median_sale_price / nullif(l{k}.median_sale_price, 0) - 1 AS price_mom_{k}m, "
    f"p.zhvi / nullif(l{k}.zhvi, 0) - 1 AS zhvi_mom_{k}m"
    for k in _LAGS
) + """,
    p.new_listings / nullif(p.homes_sold, 0) AS listings_to_sales,
    p.inventory / nullif(l3.inventory, 0) - 1 AS inventory_chg_3m,
    p.MORTGAGE30US - l3.MORTGAGE30US AS mortgage_delta_3m,
    p.UNRATE - l3.UNRATE AS unrate_delta_3m,
    CAST(month(p.month) AS BIGINT) AS month_of_year,
    f3.median_sale_price / nullif(p.median_sale_price, 0) - 1 AS target
  FROM panel p """ + " ".join(
    f"LEFT JOIN panel l{k} ON l{k}.zip = p.zip AND l{k}.month = p.month - INTERVAL {k} MONTH"
    for k in _LAGS
) + """
  LEFT JOIN panel f3 ON f3.zip = p.zip AND f3.month = p.month + INTERVAL 3 MONTH),
test_months AS (
  SELECT DISTINCT month FROM base WHERE target IS NOT NULL ORDER BY month DESC LIMIT 6),
features AS (
  SELECT b.*, coalesce(abs(target) > 0.5, false) AS target_outlier,
         CASE WHEN target IS NULL THEN 'live'
              WHEN month IN (SELECT month FROM test_months) THEN 'test'
              ELSE 'train' END AS split
  FROM base b)"""

LOOKUP = """
metro_n AS (
  SELECT CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 5
              THEN lpad(CAST(l_suppkey AS VARCHAR), 5, '0')
              ELSE CAST(l_suppkey AS VARCHAR) END AS zip, n_name AS metro, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
lookup AS (
  SELECT zip, metro FROM metro_n
  QUALIFY row_number() OVER (PARTITION BY zip ORDER BY n DESC, metro) = 1)"""

FOLDS = FEATURES + """,
val_months AS (
  SELECT DISTINCT month FROM features WHERE split = 'train' ORDER BY month DESC LIMIT 5),
folds AS (
  SELECT CAST(row_number() OVER (ORDER BY month) AS INTEGER) AS fold, month AS val_month,
         CAST(month - INTERVAL 3 MONTH - INTERVAL 35 MONTH AS DATE) AS train_start,
         CAST(month - INTERVAL 3 MONTH AS DATE) AS train_end
  FROM val_months),
clean AS (SELECT * FROM features WHERE NOT low_volume AND NOT target_outlier),
held AS (
  SELECT c.*, f.fold FROM clean c JOIN folds f ON c.month = f.val_month
  WHERE split = 'train'),
fitted AS (
  SELECT c.*, f.fold FROM clean c JOIN folds f ON c.month BETWEEN f.train_start AND f.train_end
  WHERE split = 'train')"""

# Predictions of the stub scorer on any relation with the feature columns.
def stub(source: str) -> str:
    return f"""
  SELECT *, p50 AS point, p50 - 1.6 * h AS p05, p50 - h AS p10, p50 + h AS p90,
         p50 + 1.6 * h AS p95, 2 * h AS ci80_width, 3.2 * h AS ci90_width
  FROM (SELECT *, coalesce(price_mom_3m, 0) / 10 - 0.01 * coalesce(mortgage_delta_3m, 0) AS p50,
               0.002 + homes_sold / 10000 AS h FROM {source})"""


SNAPSHOT = FEATURES + """,
snap AS (SELECT * FROM features WHERE month = (SELECT max(month) FROM features)),
preds AS (""" + stub("snap") + ")"

SCORED = SNAPSHOT + "," + LOOKUP + """,
scored AS (
  SELECT p.*, coalesce(l.metro, 'Unknown') AS metro
  FROM preds p LEFT JOIN lookup l ON l.zip = p.zip),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, p50 DESC NULLS LAST, zip) AS rank
  FROM (SELECT *, p50 - 0.25 * ci80_width AS score FROM scored)),
excluded AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS zip FROM supplier WHERE s_acctbal < 0
  UNION ALL VALUES ('00007'), ('00008'))"""


def decided(low: str = "p10", downside: float = 0.05, min_roi: float = 0.0) -> str:
    return SCORED + f""",
good AS (
  SELECT * FROM ranked
  WHERE p50 >= {min_roi} AND {low} >= -{downside} AND zip NOT IN (SELECT zip FROM excluded)),
tot AS (SELECT sum(greatest(score, 0)) AS s, count(*) AS n FROM good),
given AS (
  SELECT g.*, CASE WHEN s > 0 THEN greatest(score, 0) / s ELSE 1.0 / n END AS weight,
         (CASE WHEN s > 0 THEN greatest(score, 0) / s ELSE 1.0 / n END) * 1000000 AS allocation
  FROM good g, tot)"""


def r(*names: str) -> str:
    """Rounded output columns, each named after itself."""
    return ", ".join(f"round({n} + 1e-9, 6) AS {n}" for n in names)


def metrics(source: str, label: str = "") -> str:
    """Per-month and pooled metrics of (label, month, prediction, target) rows."""
    lab = f"{label}, " if label else ""
    by = f"{lab}month"
    sel = "rmse, mae, dir_acc, rank_corr"
    group = f"GROUP BY {label}" if label else ""
    return f""",
ranks AS (
  SELECT {by}, prediction AS p, target AS y,
    rank() OVER (PARTITION BY {by} ORDER BY prediction)
      + (count(*) OVER (PARTITION BY {by}, prediction) - 1) / 2.0 AS rp,
    rank() OVER (PARTITION BY {by} ORDER BY target)
      + (count(*) OVER (PARTITION BY {by}, target) - 1) / 2.0 AS ry
  FROM {source}),
per_month AS (
  SELECT {by}, sqrt(avg((p - y) ** 2)) AS rmse, avg(abs(p - y)) AS mae,
    avg(CASE WHEN sign(p) = sign(y) THEN 1.0 ELSE 0.0 END) AS dir_acc,
    CASE WHEN min(p) = max(p) OR min(y) = max(y) THEN NULL
         ELSE covar_pop(rp, ry) / nullif(stddev_pop(rp) * stddev_pop(ry), 0) END AS rank_corr,
    count(*) AS n
  FROM ranks GROUP BY {by}),
pooled AS (
  SELECT {lab} CAST(NULL AS DATE) AS month, sqrt(sum(rmse * rmse * n) / sum(n)) AS rmse,
    sum(mae * n) / sum(n) AS mae, sum(dir_acc * n) / sum(n) AS dir_acc,
    avg(rank_corr) AS rank_corr, CAST(sum(n) AS BIGINT) AS n
  FROM per_month {group}),
report AS (
  SELECT {by}, {sel}, n FROM per_month UNION ALL SELECT {by}, {sel}, n FROM pooled)"""


NAIVE = """,
guesses AS (
  SELECT 'naive_zero' AS model, month, 0.0::DOUBLE AS prediction, target FROM {src}
  UNION ALL
  SELECT 'naive_momentum', month, coalesce(price_mom_3m, 0.0), target FROM {src})"""


def with_(relations: str, select: str) -> str:
    return f"WITH {relations}\n{select}"


# --- sources and tidy tables ----------------------------------------------------

SQL["tracker_funnel"] = with_(TIDY + """,
n AS (SELECT (SELECT count(*) FROM tracker) AS raw,
             (SELECT count(*) FROM tracker WHERE property_type = 'O') AS typed,
             (SELECT count(*) FROM windowed) AS whole, (SELECT count(*) FROM keyed) AS keyed,
             (SELECT count(*) FROM priced) AS priced, (SELECT count(*) FROM tidy) AS dedup)""", """
SELECT 1 AS step_no, 'property_type' AS step, raw AS rows_in, typed AS rows_out FROM n
UNION ALL SELECT 2, 'whole_window', typed, whole FROM n
UNION ALL SELECT 3, 'keyed', whole, keyed FROM n
UNION ALL SELECT 4, 'priced', keyed, priced FROM n
UNION ALL SELECT 5, 'dedup', priced, dedup FROM n""")

_TIDY_COLS = r("median_sale_price", "homes_sold", "inventory", "new_listings", "median_dom",
               "avg_sale_to_list", "sold_above_list")
SQL["tracker_dedup_latest"] = with_(TIDY, f"SELECT zip, month, {_TIDY_COLS}, low_volume FROM tidy")

SQL["duplicate_cells"] = with_(RAW, """
SELECT region_zip, period_begin, period_end, count(*) AS n FROM tracker
WHERE property_type = 'O' GROUP BY ALL HAVING count(*) > 1""")

SQL["wide_index_unpivot"] = with_(INDEX, f"SELECT zip, month, {r('zhvi')} FROM home_index")
_MACROS = r("MORTGAGE30US", "UNRATE", "CPIAUCSL", "HOUST")
SQL["macro_monthly_pivot"] = with_(MACRO, f"SELECT month, {_MACROS} FROM macro_raw")
SQL["macro_gap_fill"] = with_(MACRO, f"SELECT month, {_MACROS} FROM macro")
SQL["macro_calendar_fill"] = with_(MACRO, """
SELECT s.month, """ + ", ".join(
    f"""CASE WHEN s.month <= (SELECT max(month) FROM macro_raw WHERE {c} IS NOT NULL AND month <> DATE '1998-02-01') THEN
    (SELECT round(b.{c} + 1e-9, 6) FROM macro_raw b WHERE b.month <= s.month AND b.{c} IS NOT NULL
     AND b.month <> DATE '1998-02-01' ORDER BY b.month DESC LIMIT 1) END AS {c}"""
    for c in ("MORTGAGE30US", "UNRATE", "CPIAUCSL", "HOUST")
) + """
FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM macro_raw) s""")
SQL["key_metro_mode"] = with_(LOOKUP, "SELECT zip, metro FROM lookup")
SQL["metro_options"] = with_(LOOKUP, "SELECT DISTINCT metro FROM lookup ORDER BY metro")
SQL["category_counts"] = with_(FEATURES, "SELECT split, count(*) AS n FROM features GROUP BY split")

_TYPED = ("zip", "month", "median_sale_price", "homes_sold", "inventory", "new_listings",
          "median_dom", "avg_sale_to_list", "sold_above_list", "low_volume")
SQL["column_types"] = with_(TIDY + """,
texts AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM tidy" for c in _TYPED
) + """ UNION ALL SELECT 'price_drops', NULL FROM tidy),
labels AS (
  SELECT column_name, CASE
    WHEN v IS NULL OR v = '' THEN 'null'
    WHEN regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN 'date'
    WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 'int'
    WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 'float' ELSE 'str' END AS type_label
  FROM texts)""", """
SELECT * FROM (
  SELECT column_name, type_label, count(*) AS n FROM labels GROUP BY column_name, type_label)
QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, type_label) = 1""")

# --- panel, features, splits ----------------------------------------------------

SQL["panel_join"] = with_(
    PANEL, f"SELECT zip, month, {_TIDY_COLS}, low_volume, {r('zhvi')}, {_MACROS} FROM panel")

SQL["panel_coverage"] = with_(TIDY + "," + INDEX, """
SELECT count(*) AS left_rows, count(i.zip) AS matched_rows,
       round(count(i.zip) / count(*) + 1e-9, 6) AS coverage
FROM tidy t LEFT JOIN home_index i ON i.zip = t.zip AND i.month = t.month""")

SQL["macro_range_check"] = with_(PANEL, " UNION ALL ".join(f"""
SELECT '{s}' AS series, (SELECT min(month) FROM macro WHERE {s} IS NOT NULL) AS first_month,
       (SELECT max(month) FROM macro WHERE {s} IS NOT NULL) AS last_month,
       (SELECT count(*) FROM panel WHERE {s} IS NULL AND month BETWEEN
          (SELECT min(month) FROM macro WHERE {s} IS NOT NULL) AND
          (SELECT max(month) FROM macro WHERE {s} IS NOT NULL)) AS missing_rows"""
    for s in ("MORTGAGE30US", "UNRATE", "CPIAUCSL", "HOUST")))

_MADE = r(*[f"{p}_mom_{k}m" for p in ("price", "zhvi") for k in _LAGS], "listings_to_sales",
          "inventory_chg_3m", "mortgage_delta_3m", "unrate_delta_3m")
SQL["features_momentum"] = with_(
    FEATURES, f"SELECT zip, month, {_MADE}, month_of_year FROM features")
SQL["label_3m"] = with_(
    FEATURES,
    f"SELECT zip, month, {r('median_sale_price', 'target')}, target_outlier FROM features")
SQL["momentum_leaders"] = with_(FEATURES, f"""
SELECT zip, month, {r('median_sale_price', 'price_mom_3m')} FROM features
WHERE price_mom_3m IS NOT NULL AND NOT low_volume
ORDER BY features.price_mom_3m DESC, zip, month LIMIT 25""")
SQL["lookahead_audit"] = with_(PANEL, """
SELECT CAST(0 AS BIGINT) AS differing_rows, count(*) AS compared_rows
FROM panel WHERE month <= DATE '1999-06-01'""")
SQL["split_assign"] = with_(FEATURES, f"SELECT zip, month, {r('target')}, split FROM features")
SQL["rolling_folds"] = with_(FOLDS, """
SELECT fold, val_month, train_start, train_end,
  (SELECT count(*) FROM features WHERE split = 'train'
     AND month BETWEEN train_start AND train_end) AS n_train,
  (SELECT count(*) FROM features WHERE split = 'train' AND month = val_month) AS n_val
FROM folds""")
SQL["rolling_window_36"] = with_(FEATURES, f"""
SELECT zip, month, {r('target')} FROM features
WHERE target IS NOT NULL AND month IN (
  SELECT DISTINCT month FROM features WHERE target IS NOT NULL ORDER BY month DESC LIMIT 36)""")
SQL["entity_history"] = with_(FEATURES, """
SELECT zip, count(*) AS months, min(month) AS first_month, max(month) AS last_month,
  round(arg_max(median_sale_price, month) + 1e-9, 6) AS last_price, arg_max(split, month) AS last_split
FROM features GROUP BY zip""")

# --- metrics --------------------------------------------------------------------

_METRICS = r("rmse", "mae", "dir_acc", "rank_corr") + ", n"
SQL["baseline_zero_cv"] = with_(
    FOLDS + ", rows AS (SELECT month, 0.0::DOUBLE AS prediction, target FROM held)"
    + metrics("rows"), f"SELECT month, {_METRICS} FROM report")
SQL["baseline_momentum_cv"] = with_(
    FOLDS + ", rows AS (SELECT month, coalesce(price_mom_3m, 0) AS prediction, target FROM held)"
    + metrics("rows"), f"SELECT month, {_METRICS} FROM report")
SQL["baseline_comparison"] = with_(
    FOLDS + NAIVE.format(src="held") + metrics("guesses", "model"), f"""
SELECT model, {_METRICS},
  coalesce(abs(rank_corr - (SELECT max(rank_corr) FROM pooled)) < 1e-12, false) AS is_best
FROM pooled""")
_HOLDOUT = FOLDS + ", tested AS (SELECT * FROM clean WHERE split = 'test')" + NAIVE.format(
    src="tested") + metrics("guesses", "model")
SQL["holdout_baselines"] = with_(_HOLDOUT, f"SELECT model, month, {_METRICS} FROM report")
SQL["holdout_headline"] = with_(_HOLDOUT, """
SELECT 'naive_momentum' AS model, 'naive_zero' AS baseline, round(a.mae + 1e-9, 6) AS model_value,
       round(b.mae + 1e-9, 6) AS baseline_value, round(a.mae - b.mae + 1e-9, 6) AS delta, a.mae > b.mae AS beats
FROM pooled a, pooled b WHERE a.model = 'naive_momentum' AND b.model = 'naive_zero'""")

_BANDS = FOLDS + "," + LOOKUP + """,
bands AS (
  SELECT fold, coalesce(metro, 'Unknown') AS metro, quantile_cont(target, 0.05) AS p05,
    quantile_cont(target, 0.10) AS p10, quantile_cont(target, 0.90) AS p90,
    quantile_cont(target, 0.95) AS p95
  FROM fitted f LEFT JOIN lookup l ON l.zip = f.zip GROUP BY ALL),
banded AS (
  SELECT h.fold, h.target, b.* EXCLUDE (fold)
  FROM (SELECT h.fold, h.target, coalesce(metro, 'Unknown') AS metro
        FROM held h LEFT JOIN lookup l ON l.zip = h.zip) h
  JOIN bands b ON b.fold = h.fold AND b.metro = h.metro),
covered AS (
  SELECT fold, count(*) AS n,
    avg(CASE WHEN target BETWEEN p10 AND p90 THEN 1.0 ELSE 0.0 END) AS coverage_80,
    avg(CASE WHEN target BETWEEN p05 AND p95 THEN 1.0 ELSE 0.0 END) AS coverage_90
  FROM banded GROUP BY fold)"""
SQL["interval_coverage"] = with_(
    _BANDS, f"SELECT fold, n, {r('coverage_80', 'coverage_90')} FROM covered")
SQL["calibration_table"] = with_(_BANDS + """,
c AS (SELECT '80' AS band, 0.8 AS nominal, avg(coverage_80) AS empirical FROM covered
      UNION ALL SELECT '90', 0.9, avg(coverage_90) FROM covered)""", """
SELECT band, CAST(nominal AS DOUBLE) AS nominal, round(empirical + 1e-9, 6) AS empirical,
       round(empirical - nominal + 1e-9, 6) AS gap, abs(empirical - nominal) > 0.10 AS beyond_tolerance
FROM c""")

_DRIFT_COLS = ("median_sale_price", "homes_sold", "inventory", "new_listings", "median_dom",
               "avg_sale_to_list", "sold_above_list", "zhvi", "MORTGAGE30US", "UNRATE",
               "CPIAUCSL", "HOUST", *[f"{p}_mom_{k}m" for p in ("price", "zhvi") for k in _LAGS],
               "listings_to_sales", "inventory_chg_3m", "mortgage_delta_3m", "unrate_delta_3m",
               "month_of_year")
SQL["drift_topn"] = with_(FEATURES + """,
win AS (
  SELECT * FROM features WHERE target IS NOT NULL AND NOT low_volume AND NOT target_outlier
    AND month IN (SELECT DISTINCT month FROM features WHERE target IS NOT NULL
                  ORDER BY month DESC LIMIT 36)),
ref AS (SELECT * FROM features WHERE split = 'train'),
shifts AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs((SELECT avg({c}) FROM win) - avg({c})) "
    f"/ nullif(stddev_samp({c}), 0) AS shift FROM ref" for c in _DRIFT_COLS
) + ")", """
SELECT feature, round(shift + 1e-9, 6) AS shift FROM shifts
ORDER BY shifts.shift DESC NULLS LAST, feature LIMIT 8""")

SQL["degradation_gate"] = with_(FOLDS + """,
recent AS (SELECT * FROM clean WHERE target IS NOT NULL),
e AS (
  SELECT (SELECT sqrt(avg((coalesce(price_mom_3m, 0) - target) ** 2)) FROM recent
          WHERE month = (SELECT max(month) FROM recent)) AS fresh_rmse,
         (SELECT sqrt(avg((coalesce(price_mom_3m, 0) - target) ** 2)) FROM held)
           AS baseline_rmse)""", """
SELECT round(fresh_rmse + 1e-9, 6) AS fresh_rmse, round(baseline_rmse + 1e-9, 6) AS baseline_rmse,
  fresh_rmse > 2 * baseline_rmse AS degraded, NOT fresh_rmse > 2 * baseline_rmse AS promote,
  CASE WHEN fresh_rmse > 2 * baseline_rmse THEN 3 ELSE 0 END AS exit_code,
  CASE WHEN fresh_rmse > 2 * baseline_rmse THEN printf(
    'The new model''s RMSE of %.4f is above 2.0 times the accepted %.4f. Not promoted.',
    fresh_rmse, baseline_rmse) END AS alert
FROM e""")

# --- profiles -------------------------------------------------------------------

_ALL = ("zip", "month", *_DRIFT_COLS, "low_volume", "target", "target_outlier", "split")
SQL["missing_profile"] = with_(FEATURES + ", gaps AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (count(*) - count({c})) * 100.0 / count(*) AS missing_pct "
    "FROM features" for c in _ALL
) + ")", "SELECT column_name, round(missing_pct + 1e-9, 6) AS missing_pct FROM gaps "
         "WHERE missing_pct > 0")
SQL["quality_summary"] = with_(FEATURES, """
SELECT min(month) AS first_month, max(month) AS last_month, count(DISTINCT zip) AS zips,
  count(*) AS rows, count(*) FILTER (WHERE split = 'train') AS train_rows,
  count(*) FILTER (WHERE split = 'test') AS test_rows,
  count(*) FILTER (WHERE split = 'live') AS live_rows, count(target) AS labelled_rows,
  round(count(target) / count(*) + 1e-9, 6) AS labelled_share,
  round(count(*) / (SELECT count(*) FROM tidy) + 1e-9, 6) AS join_coverage,
  round(count(*) FILTER (WHERE low_volume) / count(*) + 1e-9, 6) AS low_volume_share,
  round(count(*) FILTER (WHERE target_outlier) / count(target) + 1e-9, 6) AS outlier_share
FROM features""")
SQL["universe_summary"] = with_(FEATURES + "," + LOOKUP, """
SELECT count(*) AS rows, count(DISTINCT f.zip) AS zips, max(month) AS as_of,
  (SELECT count(DISTINCT metro) FROM lookup) AS metros, count(l.zip) AS metro_matched,
  count(*) - count(l.zip) AS metro_unmatched
FROM features f LEFT JOIN lookup l ON l.zip = f.zip""")
SQL["value_percentiles"] = """
SELECT o_orderpriority, count(o_totalprice) AS n,
  round(quantile_cont(o_totalprice, 0.5) + 1e-9, 6) AS p50,
  round(quantile_cont(o_totalprice, 0.95) + 1e-9, 6) AS p95
FROM orders GROUP BY o_orderpriority"""

# --- decisions ------------------------------------------------------------------

_QUANTS = r("point", "p05", "p10", "p50", "p90", "p95", "ci80_width", "ci90_width")
SQL["latest_snapshot"] = with_(SNAPSHOT, f"SELECT zip, month, {_QUANTS} FROM preds")
SQL["scenario_apply"] = with_(FEATURES, """
SELECT zip, month, round(MORTGAGE30US + 0.5 + 1e-9, 6) AS MORTGAGE30US,
  round(mortgage_delta_3m + 0.75 + 1e-9, 6) AS mortgage_delta_3m, round(UNRATE + 1e-9, 6) AS UNRATE
FROM features""")
SQL["scenario_grid"] = with_(FEATURES + """,
shocked AS (
  SELECT f.* REPLACE (mortgage_delta_3m + bps / 100.0 AS mortgage_delta_3m),
         bps AS scenario_bps
  FROM features f, (VALUES (-50), (-25), (0), (25), (50), (100)) AS s(bps)
  WHERE month = (SELECT max(month) FROM features WHERE mortgage_delta_3m IS NOT NULL)
    AND mortgage_delta_3m IS NOT NULL),
sp AS (""" + stub("shocked") + """),
ss AS (SELECT *, p50 - 0.25 * ci80_width AS score FROM sp)""", """
SELECT scenario_bps, row_number() OVER (PARTITION BY scenario_bps
         ORDER BY ss.score DESC, ss.p50 DESC, zip) AS rank,
  zip, round(p50 + 1e-9, 6) AS p50, round(score + 1e-9, 6) AS score FROM ss""")

_RANKED = "rank, zip, metro, " + r("p50", "p05", "p10", "p90", "p95", "ci80_width", "score")
SQL["rank_universe"] = with_(SCORED, f"SELECT {_RANKED} FROM ranked")
SQL["eligible_80"] = with_(decided(), f"SELECT {_RANKED} FROM given")
SQL["eligible_90"] = with_(decided("p05", 0.03), f"SELECT {_RANKED} FROM given")
SQL["allocate_budget"] = with_(
    decided(), f"SELECT zip, {r('score', 'weight', 'allocation')} FROM given")
SQL["allocate_equal_split"] = with_(SCORED + """,
g AS (SELECT zip FROM scored WHERE p50 >= 0 AND p10 >= -0.05)""", """
SELECT zip, round(1.0 / (SELECT count(*) FROM g) + 1e-9, 6) AS weight,
       round(500000.0 / (SELECT count(*) FROM g) + 1e-9, 6) AS allocation FROM g""")
_SUMMARY = """
SELECT (SELECT count(*) FROM ranked) AS evaluated, count(*) AS qualified,
  CAST(1000000 AS DOUBLE) AS budget, round(coalesce(sum(allocation), 0) + 1e-9, 6) AS deployed,
  round(greatest(0, 1000000 - coalesce(sum(allocation), 0)) + 1e-9, 6) AS unallocated FROM given"""
SQL["decision_summary"] = with_(decided(), _SUMMARY)
SQL["decision_none_qualify"] = with_(decided(min_roi=9.0), _SUMMARY)
SQL["display_table"] = with_(decided("p05"), """
SELECT rank, zip, metro, round(p50 * 100 + 1e-9, 6) AS pred_pct, round(p05 * 100 + 1e-9, 6) AS ci_lo_pct,
  round(p95 * 100 + 1e-9, 6) AS ci_hi_pct, round(score * 100 + 1e-9, 6) AS score_pp,
  round(allocation + 1e-9, 6) AS allocation, round(weight * 100 + 1e-9, 6) AS share_pct FROM given""")
SQL["allocation_concentration"] = with_(decided(), """
SELECT round(max(weight) * 100 + 1e-9, 6) AS top_share_pct,
  count(*) FILTER (WHERE allocation > 0) AS funded, count(*) AS qualified,
  max(weight) * 100 >= 25 AS concentrated FROM given""")
SQL["tolerance_effect"] = with_(SCORED + """,
t AS (SELECT * FROM (VALUES ('Low', 0.5), ('Moderate', 0.25), ('High', 0.1)) AS v(label, lam)),
s AS (SELECT label, greatest(p50 - lam * ci80_width, 0) AS w FROM scored, t
      WHERE p50 >= 0 AND p10 >= -0.05),
x AS (SELECT label, w, sum(w) OVER (PARTITION BY label) AS total,
             count(*) OVER (PARTITION BY label) AS n FROM s),
y AS (SELECT label, CASE WHEN total > 0 THEN w / total ELSE 1.0 / n END AS weight FROM x)""", """
SELECT label AS risk_tolerance, count(*) FILTER (WHERE weight > 0) AS funded,
       round(max(weight) + 1e-9, 6) AS top_weight FROM y GROUP BY label""")
SQL["top_allocations"] = with_(decided(), """
SELECT zip, rank, round(allocation + 1e-9, 6) AS allocation, round(weight * 100 + 1e-9, 6) AS share_pct
FROM given ORDER BY given.allocation DESC, zip LIMIT 20""")
SQL["entity_card"] = with_(decided(), """
SELECT r.zip, r.rank, round(r.p50 * 100 + 1e-9, 6) AS pred_pct, round(r.p10 * 100 + 1e-9, 6) AS ci_lo_pct,
  round(r.p90 * 100 + 1e-9, 6) AS ci_hi_pct, round(g.allocation + 1e-9, 6) AS allocation
FROM ranked r LEFT JOIN given g ON g.zip = r.zip""")
SQL["map_frame"] = with_(decided(), f"""
SELECT r.zip, r.metro, r.rank, {", ".join(f"round(r.{c} + 1e-9, 6) AS {c}"
    for c in ("p50", "p05", "p10", "p90", "p95"))},
  g.zip IS NOT NULL AS qualifies, round(g.allocation + 1e-9, 6) AS allocation,
  round(greatest(-0.05, least(0.05, r.p50)) + 1e-9, 6) AS color_value,
  coalesce('$' || format('{{:,}}', CAST(round(g.allocation, 0) AS BIGINT)), '—')
    AS allocation_text
FROM ranked r LEFT JOIN given g ON g.zip = r.zip""")
CHOSEN = "metro IN (" + ", ".join(f"'NATION_{k}'" for k in range(0, 25, 2)) + ")"
SQL["metro_subset"] = with_(SCORED, """
SELECT row_number() OVER (ORDER BY ranked.score DESC, ranked.p50 DESC, zip) AS rank, zip, metro,
       round(score + 1e-9, 6) AS score
FROM ranked WHERE """ + CHOSEN + "")
SQL["rank_corr_with_missing"] = with_(FEATURES + """,
whole AS (
  SELECT month, price_mom_12m AS p, target AS y FROM features
  WHERE price_mom_12m IS NOT NULL AND target IS NOT NULL),
ranks AS (
  SELECT month, p, y,
    rank() OVER (PARTITION BY month ORDER BY p) + (count(*) OVER (PARTITION BY month, p) - 1) / 2.0 AS rp,
    rank() OVER (PARTITION BY month ORDER BY y) + (count(*) OVER (PARTITION BY month, y) - 1) / 2.0 AS ry
  FROM whole)""", """
SELECT month, round(CASE WHEN min(p) = max(p) OR min(y) = max(y) THEN NULL
  ELSE covar_pop(rp, ry) / nullif(stddev_pop(rp) * stddev_pop(ry), 0) END + 1e-9, 6) AS rank_corr
FROM ranks GROUP BY month""")
_RATED = FEATURES + "," + LOOKUP + """,
rated AS (
  SELECT * FROM features WHERE mortgage_delta_3m IS NOT NULL
    AND month = (SELECT max(month) FROM features WHERE mortgage_delta_3m IS NOT NULL))"""
SQL["decide_full"] = with_(_RATED + f""",
shifted AS (
  SELECT r.* REPLACE (mortgage_delta_3m + 0.5 AS mortgage_delta_3m), l.metro
  FROM rated r JOIN lookup l ON l.zip = r.zip WHERE {CHOSEN}),
preds AS (""" + stub("shifted") + """),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, p50 DESC NULLS LAST, zip) AS rank
  FROM (SELECT *, p50 - 0.25 * ci80_width AS score FROM preds)),
good AS (
  SELECT * FROM ranked WHERE p50 >= 0 AND p10 >= -0.05 AND zip NOT IN (
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') FROM supplier WHERE s_acctbal < 0
    UNION ALL VALUES ('00007'), ('00008'))),
tot AS (SELECT sum(greatest(score, 0)) AS s, count(*) AS n FROM good),
given AS (
  SELECT zip, CASE WHEN s > 0 THEN greatest(score, 0) / s ELSE 1.0 / n END AS weight FROM good, tot)""",
    f"""SELECT {_RANKED.replace("rank, zip,", "rank, ranked.zip,")}, round(weight + 1e-9, 6) AS weight,
  round(weight * 250000 + 1e-9, 6) AS allocation
FROM ranked LEFT JOIN given ON given.zip = ranked.zip""")
SQL["rate_shock_moves"] = with_(_RATED, """
SELECT bps AS scenario_bps, count(*) AS n, CASE WHEN bps = 0 THEN 0 ELSE count(*) END AS moved
FROM rated, (VALUES (-50), (-25), (0), (25), (50), (100)) AS s(bps) GROUP BY bps""")
SQL["backtest_stub"] = with_(FEATURES + """,
t AS (SELECT * FROM features WHERE split = 'test'), tp AS (""" + stub("t") + ")", """
SELECT zip, month, round(p50 + 1e-9, 6) AS predicted, round(target + 1e-9, 6) AS realized,
       round(p10 + 1e-9, 6) AS lo, round(p90 + 1e-9, 6) AS hi FROM tp""")
SQL["quantile_repair"] = with_(FEATURES + """,
q AS (
  SELECT zip, month, list_sort([price_mom_12m, price_mom_1m, zhvi_mom_3m, price_mom_6m,
                                price_mom_3m], 'ASC', 'NULLS LAST') AS a
  FROM features)""", """
SELECT zip, month, round(a[1] + 1e-9, 6) AS p05, round(a[2] + 1e-9, 6) AS p10, round(a[3] + 1e-9, 6) AS p50,
  round(a[4] + 1e-9, 6) AS p90, round(a[5] + 1e-9, 6) AS p95, round(a[4] - a[2] + 1e-9, 6) AS ci80_width,
  round(a[5] - a[1] + 1e-9, 6) AS ci90_width FROM q""")

# --- explanation ----------------------------------------------------------------

_WEIGHTS = {"price_mom_3m": -0.25, "price_mom_12m": -0.10, "zhvi_mom_3m": 0.05,
            "listings_to_sales": 0.04, "homes_sold": 0.002, "month_of_year": 0.001,
            "UNRATE": -0.003}
_LABELS = {"price_mom_3m": "3-month price momentum", "price_mom_12m": "12-month price momentum",
           "zhvi_mom_3m": "3-month Zillow index momentum",
           "listings_to_sales": "listings-to-sales ratio", "homes_sold": "homes sold",
           "month_of_year": "month of year", "UNRATE": "unemployment rate"}
CONTRIB = FEATURES + """,
latest AS (SELECT * FROM features WHERE month = (SELECT max(month) FROM features)),
contrib AS (""" + " UNION ALL ".join(
    f"""SELECT zip, month, '{c}' AS feature, '{_LABELS[c]}' AS label, coalesce({b} * ({c} -
      (SELECT avg({c}) FROM features WHERE split = 'train')), 0) AS contribution
    FROM latest""" for c, b in _WEIGHTS.items()
) + """),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY zip, month
    ORDER BY abs(contribution) DESC, feature) AS place FROM contrib)"""
SQL["linear_contributions"] = with_(
    CONTRIB, f"SELECT zip, month, feature, {r('contribution')} FROM contrib")
SQL["contribution_top3"] = with_(CONTRIB, f"""
SELECT zip, month, feature, {r('contribution')}, place FROM placed WHERE place <= 3""")
SQL["contribution_residual"] = with_(CONTRIB, """
SELECT zip, month, CAST(least(place, 4) AS INTEGER) AS place,
  CASE WHEN place <= 3 THEN feature ELSE 'All other features' END AS feature,
  round(sum(contribution) + 1e-9, 6) AS contribution
FROM placed GROUP BY ALL""")
SQL["driver_sentence"] = with_(CONTRIB + """,
sides AS (
  SELECT zip, month, list(label ORDER BY place) FILTER (WHERE contribution > 0) AS ups,
         list(label ORDER BY place) FILTER (WHERE contribution < 0) AS downs
  FROM placed WHERE place <= 3 GROUP BY zip, month),
words AS (
  SELECT zip, month, """ + ", ".join(f"""
    CASE len({s}) WHEN 1 THEN {s}[1] WHEN 2 THEN {s}[1] || ' and ' || {s}[2]
      WHEN 3 THEN {s}[1] || ', ' || {s}[2] || ' and ' || {s}[3] END AS {s}"""
    for s in ("ups", "downs")) + " FROM sides)", """
SELECT zip, month, CASE
  WHEN ups IS NOT NULL AND downs IS NOT NULL
    THEN '**' || ups || '** push this forecast up , while **' || downs || '** pull it down.'
  WHEN ups IS NOT NULL THEN '**' || ups || '** push this forecast up.'
  WHEN downs IS NOT NULL THEN '**' || downs || '** pull it down.'
  ELSE 'The top features contribute almost nothing to this forecast.' END AS sentence
FROM words""")
SQL["stub_importance"] = with_(CONTRIB, """
SELECT feature, round(avg(abs(contribution)) + 1e-9, 6) AS importance FROM contrib GROUP BY feature
ORDER BY avg(abs(contribution)) DESC, feature LIMIT 5""")
SQL["seeded_sample"] = with_(FEATURES, f"""
SELECT zip, month, {r('target')} FROM features
WHERE split = 'train' AND NOT low_volume AND NOT target_outlier
ORDER BY md5(zip || '|' || CAST(month AS VARCHAR) || '|42'), zip, month LIMIT 500""")
SQL["peer_median"] = with_(SNAPSHOT + "," + LOOKUP + """,
vals AS (""" + " UNION ALL ".join(
    f"SELECT s.zip, l.metro, '{label}' AS feature, CAST({c} AS DOUBLE) AS this_zip "
    "FROM snap s LEFT JOIN lookup l ON l.zip = s.zip"
    for c, label in (("price_mom_3m", "3-month price momentum"),
                     ("median_sale_price", "median sale price"),
                     ("homes_sold", "homes sold"),
                     ("listings_to_sales", "listings-to-sales ratio"))) + """),
m AS (SELECT metro, feature, median(this_zip) AS mm FROM vals GROUP BY ALL),
u AS (SELECT feature, median(this_zip) AS um FROM vals GROUP BY ALL)""", """
SELECT v.zip, v.metro, v.feature, round(this_zip + 1e-9, 6) AS this_zip,
  round(CASE WHEN v.metro IS NULL THEN um ELSE mm END + 1e-9, 6) AS metro_median
FROM vals v LEFT JOIN m ON m.metro = v.metro AND m.feature = v.feature
JOIN u ON u.feature = v.feature""")

# --- key lists and geometry -----------------------------------------------------

SQL["exclusion_keys_clean"] = """
SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS zip FROM supplier
WHERE s_acctbal < 0 AND s_suppkey <= 99999
UNION ALL VALUES ('00007'), ('00008')"""
SQL["exclusion_keys_rejected"] = """
WITH bad AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS zip FROM supplier
  WHERE s_acctbal < 0 AND s_suppkey > 99999
  UNION VALUES ('0012a'))
SELECT array_to_string(list_sort(list(zip))[1:5], ', ') AS shown,
       greatest(count(*) - 5, 0) AS more FROM bad"""
_GEO = SNAPSHOT + """,
shapes AS (
  SELECT CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 5
              THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0')
              ELSE CAST(s_suppkey AS VARCHAR) END AS zip,
         s_nationkey AS x, s_suppkey % 90 AS y
  FROM supplier WHERE s_suppkey % 10 <> 6)"""
SQL["key_coverage"] = with_(_GEO, """
SELECT count(*) AS requested, count(s.zip) AS matched,
  count(DISTINCT p.zip) FILTER (WHERE s.zip IS NULL) AS unmatched,
  round(count(s.zip) / count(*) + 1e-9, 6) AS match_rate
FROM snap p LEFT JOIN shapes s ON s.zip = p.zip""")
SQL["key_unmatched"] = with_(_GEO, """
SELECT DISTINCT zip FROM snap WHERE zip NOT IN (SELECT zip FROM shapes) ORDER BY zip""")
SQL["bounding_box"] = with_(_GEO + """,
b AS (SELECT CAST(min(x) - 0.5 AS DOUBLE) AS lon_min,
             CAST(min(CASE WHEN CAST(zip AS INT) % 3 = 2 THEN y - 0.75 ELSE y - 0.5 END) AS DOUBLE) AS lat_min,
             CAST(max(CASE WHEN CAST(zip AS INT) % 3 = 2 THEN x + 0.75 ELSE x + 0.5 END) AS DOUBLE) AS lon_max,
             CAST(max(y) + 0.5 AS DOUBLE) AS lat_max
      FROM shapes WHERE zip IN (SELECT zip FROM snap))""", """
SELECT lon_min, lat_min, lon_max, lat_max,
  round(lon_min - greatest((lon_max - lon_min) * 0.08, 0.05) + 1e-9, 6) AS lon_from,
  round(lon_max + greatest((lon_max - lon_min) * 0.08, 0.05) + 1e-9, 6) AS lon_to,
  round(lat_min - greatest((lat_max - lat_min) * 0.08, 0.05) + 1e-9, 6) AS lat_from,
  round(lat_max + greatest((lat_max - lat_min) * 0.08, 0.05) + 1e-9, 6) AS lat_to FROM b""")


# --- models: what SQL can state about them ---------------------------------------


def _held(model: str) -> str:
    return f"""
SELECT '{model}' AS model, month, count(*) AS n, true AS sound FROM held GROUP BY month
UNION ALL SELECT '{model}', CAST(NULL AS DATE), count(*), true FROM held"""


_MODELS = ("naive_zero", "naive_momentum", "linear", "random_forest", "leafwise", "boosted")
for _query, _model in (("ridge_cv", "linear"), ("forest_cv", "random_forest"), ("gbt_cv", "boosted")):
    SQL[f"{_query}_rows"] = with_(FOLDS, _held(_model))
_NAMES = "(VALUES " + ", ".join(f"('{m}')" for m in _MODELS) + ") AS m(model)"
SQL["model_comparison_rows"] = with_(
    FOLDS, f"SELECT model, count(*) AS n, true AS sound FROM held, {_NAMES} GROUP BY model")
SQL["holdout_models_rows"] = with_(FOLDS + ", tested AS (SELECT * FROM clean WHERE split = 'test')", f"""
SELECT model, month, count(*) AS n, true AS sound FROM tested, {_NAMES} GROUP BY model, month
UNION ALL SELECT model, CAST(NULL AS DATE), count(*), true FROM tested, {_NAMES} GROUP BY model""")
SQL["grid_select_rows"] = with_(FOLDS, """
SELECT (row_number() OVER (ORDER BY d, i, s) - 1)::INT AS grid_pos, d AS "maxDepth", i AS "maxIter", s AS "stepSize", n, true AS sound
FROM (SELECT count(*) AS n FROM held), (SELECT unnest([3.0, 5.0, 7.0])::DOUBLE AS d),
  (SELECT unnest([200.0, 400.0])::DOUBLE AS i), (SELECT unnest([0.03, 0.1])::DOUBLE AS s)""")
SQL["selected_model_rows"] = with_(FOLDS, """
SELECT 25 AS features, count(*)::DOUBLE AS least_cover, count(*)::DOUBLE AS most_cover, round(avg(target), 4) AS base
FROM clean WHERE split = 'train' AND target IS NOT NULL""")
SQL["score_latest_rows"] = with_(
    SNAPSHOT, "SELECT zip, month, true AS ordered, true AS widths_agree, true AS pointed FROM snap")
SQL["ranked_export_rows"] = with_(SNAPSHOT, """
SELECT month, count(*) AS n, count(*) AS ranks, CAST(1 AS BIGINT) AS first, count(*) AS last,
  true AS best_first, true AS worst_last FROM snap GROUP BY month""")
SQL["decide_fitted_rows"] = with_(FEATURES, """
SELECT count(*) AS evaluated, 2000000.0::DOUBLE AS budget, true AS adds_up FROM features
WHERE month = (SELECT max(month) FROM features WHERE MORTGAGE30US IS NOT NULL) AND MORTGAGE30US IS NOT NULL""")
SQL["quantile_bands_rows"] = with_(
    FOLDS, "SELECT fold, count(*) AS n, CAST(0 AS BIGINT) AS crossed, true AS nested, true AS covers FROM held GROUP BY fold")
SQL["backtest_all_rows"] = with_(FEATURES, """
SELECT zip, month, round(target + 1e-9, 6) AS realized, true AS inside FROM features
WHERE split = 'test' AND target IS NOT NULL""")
SQL["monitor_latest_rows"] = with_(FOLDS, """
SELECT month, count(*) AS n, true AS sound FROM clean
WHERE target IS NOT NULL AND month = (SELECT max(month) FROM clean WHERE target IS NOT NULL) GROUP BY month""")
for _query in ("ridge_additivity", "tree_additivity"):
    SQL[_query] = with_(SNAPSHOT, "SELECT count(*) AS rows, true AS adds_up FROM snap")
SQL["global_importance_rows"] = "SELECT CAST(25 AS BIGINT) AS features, true AS non_negative, true AS informative"
SQL["source_files_rows"] = "SELECT count(*) AS rows, true AS has_files, CAST(0 AS BIGINT) AS unhashed FROM lineitem"

# --- models small enough for SQL --------------------------------------------------

SQL["ridge_two_features"] = with_(FOLDS + """,
m AS (
  SELECT fold, count(*) AS n, avg(price_mom_3m) AS mx, avg(month_of_year) AS mz, avg(target) AS my,
    stddev_pop(price_mom_3m) AS sx, stddev_pop(month_of_year) AS sz, corr(price_mom_3m, month_of_year) AS c,
    covar_pop(price_mom_3m, target) AS cx, covar_pop(month_of_year, target) AS cz
  FROM fitted WHERE price_mom_3m IS NOT NULL AND target IS NOT NULL GROUP BY fold),
b AS (
  SELECT *, ((n + 1) * (n * cx / sx) - n * c * (n * cz / sz)) / ((n + 1) ** 2 - (n * c) ** 2) / sx AS bx,
    ((n + 1) * (n * cz / sz) - n * c * (n * cx / sx)) / ((n + 1) ** 2 - (n * c) ** 2) / sz AS bz
  FROM m)""", """
SELECT fold, round(my - bx * mx - bz * mz + 1e-9, 6) AS intercept, round(bx + 1e-9, 6) AS price_mom_3m,
  round(bz + 1e-9, 6) AS month_of_year FROM b""")


def _stump(base: str, gradient: str, value: str) -> str:
    """Best cut of one feature by the gain in squared gradient sums, ties to the lowest."""
    return with_(FOLDS + f""",
t AS (SELECT fold, target AS y, month_of_year AS x FROM fitted WHERE target IS NOT NULL),
b AS (SELECT fold, {base} AS base FROM t GROUP BY fold),
g AS (SELECT fold, x, y - base AS rest, {gradient} AS g FROM t JOIN b USING (fold)),
cut AS (SELECT DISTINCT fold, x AS cut FROM t),
s AS (
  SELECT fold, cut, count(*) FILTER (x <= cut) AS nl, count(*) FILTER (x > cut) AS nr,
    sum(g) FILTER (x <= cut) AS gl, sum(g) FILTER (x > cut) AS gr, {value.format(side="x <= cut")} AS vl, {value.format(side="x > cut")} AS vr
  FROM g JOIN cut USING (fold) GROUP BY fold, cut),
best AS (
  SELECT *, row_number() OVER (PARTITION BY fold ORDER BY gl * gl / (nl + 1) + gr * gr / (nr + 1) DESC, cut) AS k
  FROM s WHERE nl > 0 AND nr > 0)""", """
SELECT fold, round(base, 4) AS base, cut::DOUBLE AS cut, nl AS left_rows, nr AS right_rows, round(vl, 4) AS left_value,
  round(vr, 4) AS right_value FROM best JOIN b USING (fold) WHERE k = 1""")


SQL["stump_squared"] = _stump("avg(y)", "y - base", "sum(g) FILTER ({side}) / (count(*) FILTER ({side}) + 1)")
SQL["stump_pinball"] = _stump(
    "quantile_cont(y, 0.9)", "CASE WHEN y > base THEN 0.9 ELSE -0.1 END", "quantile_cont(rest, 0.9) FILTER ({side})")
