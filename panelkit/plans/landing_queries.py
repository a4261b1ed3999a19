"""Registered queries of files: sources are written out, read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import decide
from panelkit.plans import landing, refresh, training
from panelkit.plans.build import feature_table, written_once
from panelkit.plans.oracle import SQL
from panelkit.plans.queries import MODEL, PARAMS, query, scored
from panelkit.sinks import runs, tables
from panelkit.sources import bind
from panelkit.sources.readers import read_series, read_table, read_tracker
from panelkit.staging import stage


def _landed(spark: SparkSession, folder: str) -> landing.Landed:
    place = landing.landing_folder(spark)
    return landing.from_files(
        spark,
        landing.land_tracker(bind.tracker_with_metros(spark, folder), f"{place}/tracker"),
        landing.land_wide(bind.index_wide(spark, folder), f"{place}/index"),
        landing.land_series(bind.macro_observations(spark, folder), f"{place}/series"),
        PARAMS,
    )


@query
def landed_panel(spark, folder):
    """The panel from compressed text, wide CSV and nested JSON."""
    return _landed(spark, folder).panel


SQL["landed_panel"] = SQL["panel_join"]


@query
def landed_lookup(spark, folder):
    """Metros counted in the landed tracker, the most frequent one per zip."""
    return _landed(spark, folder).lookup


SQL["landed_lookup"] = SQL["key_metro_mode"]


def _corrected(rows: DataFrame) -> DataFrame:
    """The rows of one year as landed a second time: other prices, and thin cells withdrawn."""
    own = rows.filter(F.year("period_end") == 1998).withColumn("median_sale_price", F.col("median_sale_price") + 7.0)
    return own.filter(F.col("homes_sold") >= 3)


def _land_all(spark: SparkSession, folder: str, place: str):
    """(tracker rows, globs of the three sources) of a first landing."""
    rows = stage(bind.tracker(spark, folder), "tracker")
    return rows, (
        landing.land_tracker_by_year(rows, f"{place}/tracker"),
        f"{landing.land_wide(bind.index_wide(spark, folder), f'{place}/index')}/*.csv",
        landing.land_series(bind.macro_observations(spark, folder), f"{place}/series"),
    )


def _twice_landed(spark: SparkSession, folder: str):
    """(root, what the second refresh did) after a full landing and a corrected file."""
    place = landing.landing_folder(spark)
    rows, files = _land_all(spark, folder, place)
    refresh.refresh(spark, f"{place}/store", *files, PARAMS)
    landing.land_tracker_by_year(_corrected(rows), f"{place}/tracker")
    done = refresh.refresh(spark, f"{place}/store", *files, PARAMS)
    again = refresh.refresh(spark, f"{place}/store", *files, PARAMS)
    return f"{place}/store", done, again


@query
def refreshed_panel(spark, folder):
    """The panel after one changed file, rebuilt only in the months of that file."""
    root, _, _ = _twice_landed(spark, folder)
    return refresh.current_panel(spark, root)


_CORRECTED = """
corrected AS (
  SELECT * REPLACE (CASE WHEN year(period_end) = 1998 THEN median_sale_price + 7 ELSE median_sale_price END AS median_sale_price)
  FROM tracker WHERE year(period_end) <> 1998 OR homes_sold >= 3),
windowed AS ("""
SQL["refreshed_panel"] = SQL["panel_join"].replace("\nwindowed AS (", _CORRECTED).replace(
    "FROM tracker\n  WHERE property_type", "FROM corrected\n  WHERE property_type")


@query
def refresh_scope(spark, folder):
    """Files read, files gone and months rebuilt by the second refresh, and by a third without changes."""
    _, done, again = _twice_landed(spark, folder)
    rows = [(k, len(r.read), len(r.gone), len(r.months)) for k, r in (("changed", done), ("unchanged", again))]
    return spark.createDataFrame(rows, "landing string, files_read int, files_gone int, months int")


SQL["refresh_scope"] = "WITH " + SQL["duplicate_cells"].split("WITH ", 1)[1].split("\nSELECT")[0] + """
SELECT 'changed' AS landing, 1 AS files_read, 1 AS files_gone, count(DISTINCT date_trunc('month', period_end))::INT AS months
FROM tracker WHERE year(period_end) = 1998
UNION ALL SELECT 'unchanged', 0, 0, 0"""


def _retrained(spark: SparkSession, folder: str) -> DataFrame:
    """Train on a first landing, land a corrected year, retrain from the files, all with the full settings."""

    def build(session, path):
        place = landing.landing_folder(session)
        rows, files = _land_all(session, path, place)
        refresh.refresh(session, f"{place}/store", *files, PARAMS)
        features = feature_table(refresh.current_panel(session, f"{place}/store"), PARAMS)
        training.train_and_save(features, place, "v1", PARAMS, MODEL)
        landing.land_tracker_by_year(_corrected(rows), f"{place}/tracker")
        done, made = training.retrain_from_files(session, place, "v2", *files, PARAMS, MODEL)
        latest = tables.latest_path(session, f"{place}/models").rsplit("/", 1)[1]
        row = made.decision
        facts = [(len(done.read), len(done.months), row["fresh_rmse"], row["baseline_rmse"], row["degraded"], row["promote"], row["exit_code"], latest)]
        return session.createDataFrame(
            facts, "files_read int, months_rebuilt int, fresh_rmse double, baseline_rmse double, degraded boolean, "
            "promote boolean, exit_code int, latest string"
        )

    return written_once(spark, folder, "retrained", build)


@query
def retrain_cycle(spark, folder):
    """One cycle from landed files to the promoted version, with its monitoring figures."""
    return _retrained(spark, folder)


@query
def retrain_cycle_rows(spark, folder):
    """One file read, its months rebuilt, and a gate that follows from the two errors."""
    bad = F.col("fresh_rmse") > MODEL.degradation_multiplier * F.col("baseline_rmse")
    return _retrained(spark, folder).select(
        "files_read",
        "months_rebuilt",
        (F.col("degraded") == bad).alias("gated"),
        (F.col("promote") != F.col("degraded")).alias("promoted_if_good"),
        (F.col("latest") == F.when(F.col("promote"), "v2").otherwise("v1")).alias("latest_follows"),
    )


SQL["retrain_cycle_rows"] = "WITH " + SQL["duplicate_cells"].split("WITH ", 1)[1].split("\nSELECT")[0] + """
SELECT 1 AS files_read, count(DISTINCT date_trunc('month', period_end))::INT AS months_rebuilt,
  true AS gated, true AS promoted_if_good, true AS latest_follows
FROM tracker WHERE year(period_end) = 1998"""


@query
def landed_series(spark, folder):
    """Observations of every series through nested JSON."""
    place = landing.landing_folder(spark)
    files = landing.land_series(bind.macro_observations(spark, folder), place)
    return read_series(spark, files).groupBy("series").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if(F.col("value") == ".").alias("blank"),
        F.sum(F.col("value").try_cast("double")).alias("total"),
    )


SQL["landed_series"] = """
WITH weekly AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'MORTGAGE30US' WHEN '2-HIGH' THEN 'UNRATE'
      WHEN '3-MEDIUM' THEN 'CPIAUCSL' ELSE 'HOUST' END AS series,
    CAST(date_trunc('week', o_orderdate) AS DATE) AS date, avg(o_totalprice) / 10000 AS v
  FROM orders GROUP BY ALL),
b AS (SELECT *, series = 'UNRATE' AND date_trunc('month', date) = DATE '1999-10-01' AS blank FROM weekly)
SELECT series, count(*) AS n, min(date) AS first, max(date) AS last, count(*) FILTER (blank) AS blank,
  round(sum(v) FILTER (NOT blank) + 1e-9, 6) AS total FROM b GROUP BY series"""


@query
def landed_tracker(spark, folder):
    """Typed tracker rows read back from compressed text."""
    place = landing.landing_folder(spark)
    rows = read_tracker(spark, landing.land_tracker(bind.tracker(spark, folder), f"{place}/tracker"))
    return rows.select(
        "region_zip", "property_type", "period_begin", "period_end", "median_sale_price", "homes_sold", "median_dom"
    )


SQL["landed_tracker"] = "WITH " + SQL["duplicate_cells"].split("WITH ", 1)[1].split("\nSELECT")[0] + """
SELECT region_zip, property_type, period_begin, period_end, round(median_sale_price + 1e-9, 6) AS median_sale_price,
  round(homes_sold + 1e-9, 6) AS homes_sold, round(median_dom + 1e-9, 6) AS median_dom FROM tracker"""


@query
def one_zip_history(spark, folder):
    """A written table read with a projection and a pushed key predicate."""
    place = f"{landing.landing_folder(spark)}/index"
    tables.write_table(bind.index(spark, folder), place, ["zip", "month"])
    return read_table(spark, place, ["zip", "month", "zhvi"]).filter(F.col("zip") == "00005")


SQL["one_zip_history"] = SQL["wide_index_unpivot"] + " WHERE zip = '00005'"


@query
def exported_ranking(spark, folder):
    """The ranked export of the latest month, through CSV."""
    place = f"{landing.landing_folder(spark)}/ranking"
    tables.export_csv(decide.rank(scored(spark, folder), 0.25).select("rank", "zip", "metro", "p50", "score"), place)
    return spark.read.schema("rank bigint, zip string, metro string, p50 double, score double").csv(place, header=True)


SQL["exported_ranking"] = SQL["rank_universe"].replace(
    SQL["rank_universe"].rsplit("SELECT ", 1)[1].split(" FROM")[0],
    "rank, zip, metro, round(p50 + 1e-9, 6) AS p50, round(score + 1e-9, 6) AS score",
)


@query
def sections_replaced(spark, folder):
    """A section written twice holds the later rows; one written empty holds none."""
    place = f"{landing.landing_folder(spark)}/sections"
    nations = bind.table(spark, folder, "nation").select(F.col("n_name").alias("name"))
    regions = bind.table(spark, folder, "region").select(F.col("r_name").alias("name"))
    for rows, section in ((nations, "join"), (nations, "split"), (nations, "gone"), (regions, "join"), (nations.limit(0), "gone")):
        tables.write_section(rows, place, section)
    return tables.read_sections(spark, place).select("section", "name")


SQL["sections_replaced"] = """
SELECT 'join' AS section, r_name AS name FROM region UNION ALL SELECT 'split', n_name FROM nation"""


@query
def version_promoted_last(spark, folder):
    """v10 follows v9, v11 is not promoted, and v9 is promoted again."""
    place = f"{landing.landing_folder(spark)}/versions"
    nations = bind.table(spark, folder, "nation").select(F.col("n_name").alias("name"))
    regions = bind.table(spark, folder, "region").select(F.col("r_name").alias("name"))
    older = tables.publish(nations, place, "v9")
    tables.publish(regions, place, "v10")
    between = tables.read_latest(spark, place).select(F.lit("v10").alias("latest"), "name")
    tables.publish(nations, place, "v11", promote=False)
    tables.record_version(spark, place, "v9", older, True)
    return between.unionByName(tables.read_latest(spark, place).select(F.lit("v9").alias("latest"), "name"))


SQL["version_promoted_last"] = """
SELECT 'v10' AS latest, r_name AS name FROM region UNION ALL SELECT 'v9', n_name FROM nation"""


@query
def run_log(spark, folder):
    """An append-only log of two runs; the last training run gives the baseline."""
    place = f"{landing.landing_folder(spark)}/runs"
    lines = bind.table(spark, folder, "lineitem").count()
    for version, rmse in (("a", 1.0), ("b", float(lines))):
        runs.log_run(spark, place, kind="train", version=version, settings={"maxDepth": 3.0}, baseline_rmse=rmse, promoted=True)
    settings, baseline = runs.selected_settings(spark, place)
    logged = spark.read.parquet(place)
    return logged.agg(F.count(F.lit(1)).alias("runs")).select(
        "runs", F.lit(baseline).alias("baseline"), F.lit(float(settings["maxDepth"])).alias("depth")
    )


SQL["run_log"] = "SELECT CAST(2 AS BIGINT) AS runs, CAST(count(*) AS DOUBLE) AS baseline, 3.0::DOUBLE AS depth FROM lineitem"
