"""Registered queries of contracts, guards and file forms: errors become rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.errors import PanelError
from panelkit.functions.text import money, percent
from panelkit.operators import contracts, decide, features, split, tidy
from panelkit.plans import landing
from panelkit.plans.build import bound_features, bound_panel
from panelkit.plans.oracle import _ALL, FEATURES, FOLDS, RAW, SQL, with_
from panelkit.plans.oracle import decided as decided_sql
from panelkit.plans.queries import CHOSEN_METROS, MODEL, PARAMS, decided, query, unflagged
from panelkit.sinks import tables
from panelkit.sources import bind, lists
from panelkit.sources.readers import read_geometries, read_table, read_tracker
from panelkit.staging import file_system, stage


def outcome(attempt: Callable[[], object]) -> str:
    """What an attempt returns, or the name of the error that stops it."""
    try:
        return str(attempt())
    except PanelError as error:
        return type(error).__name__


def outcomes(spark: SparkSession, attempts: dict[str, Callable[[], object]]) -> DataFrame:
    return spark.createDataFrame([(k, outcome(f)) for k, f in attempts.items()], "attempt string, outcome string")


# --- sources --------------------------------------------------------------------


@query
def landed_geometries(spark, folder):
    """Ids and kinds of geometries read from feature collections of a thousand features each."""
    place = f"{landing.landing_folder(spark)}/shapes"
    shapes = bind.geometries(spark, folder).select(
        F.floor(F.col("id").cast("long") / 1000).alias("part"),
        F.format_string('{"type":"Feature","properties":{"zip":" %s"},"geometry":%s}', "id", "geometry").alias("feature"),
    )
    whole = shapes.groupBy("part").agg(F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"))
    body = F.concat(F.lit('{"type":"FeatureCollection","features":['), "features", F.lit("]}")).alias("value")
    whole.select("part", body).repartition("part").write.partitionBy("part").text(place)
    back = read_geometries(spark, f"{place}/part=*/*.txt")
    return back.select("id", F.get_json_object("geometry", "$.type").alias("kind"))


SQL["landed_geometries"] = """
SELECT CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 5 THEN lpad(CAST(s_suppkey AS VARCHAR), 5, '0')
            ELSE CAST(s_suppkey AS VARCHAR) END AS id,
  CASE s_suppkey % 3 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'MultiPolygon' ELSE 'GeometryCollection' END AS kind
FROM supplier WHERE s_suppkey % 10 <> 6"""


@query
def guarded_reads(spark, folder):
    """Rows of a table that is there, and the error for one that is not and for one that is empty of files."""
    place = landing.landing_folder(spark)
    system, empty = file_system(spark, f"{place}/empty")
    system.mkdirs(empty)
    count = lambda path: lambda: read_table(spark, path, hint="Land it first.").count()
    return outcomes(spark, {"there": count(f"{folder}/supplier.parquet"), "absent": count(f"{place}/absent"), "empty": count(f"{place}/empty")})


SQL["guarded_reads"] = """
SELECT 'there' AS attempt, CAST(count(*) AS VARCHAR) AS outcome FROM supplier
UNION ALL SELECT 'absent', 'MissingInputError' UNION ALL SELECT 'empty', 'MissingInputError'"""


@query
def key_list_forms(spark, folder):
    """The same keys as a bare column and under a header in another case."""
    place = landing.landing_folder(spark)
    raw = bind.exclusion_values(spark, folder).filter("value <> ''")
    raw.write.csv(f"{place}/bare")
    raw.select(F.col("value").alias(" ZIP "), F.lit(1).alias("other")).write.csv(f"{place}/named", header=True)
    forms = [lists.clean_keys(lists.read_key_list(spark, f"{place}/{f}")).select(F.lit(f).alias("form"), "zip") for f in ("bare", "named")]
    return forms[0].unionByName(forms[1])


SQL["key_list_forms"] = f"""
SELECT f AS form, zip FROM ({SQL["exclusion_keys_clean"]}), (VALUES ('bare'), ('named')) AS v(f)"""


@query
def renamed_tracker(spark, folder):
    """Tracker rows from a file with other spellings and other names of its columns."""
    place = f"{landing.landing_folder(spark)}/tracker"
    rows = bind.tracker(spark, folder)
    names = {"region_zip": "REGION", "period_begin": "Period Begin", "property_type": "PROPERTY-TYPE"}
    other = rows.toDF(*[names.get(c, c.upper()) for c in rows.columns])
    back = read_tracker(spark, landing.land_tracker(other, place))
    return back.select(
        "region_zip", "property_type", "period_begin", "period_end", "median_sale_price", "homes_sold", "median_dom"
    )


SQL["renamed_tracker"] = with_(RAW, """
SELECT region_zip, property_type, period_begin, period_end, round(median_sale_price + 1e-9, 6) AS median_sale_price,
  round(homes_sold + 1e-9, 6) AS homes_sold, round(median_dom + 1e-9, 6) AS median_dom FROM tracker""")


@query
def chosen_metro_rows(spark, folder):
    """Rows of some metros, and of all when none is named."""
    rows = bind.tracker_with_metros(spark, folder)
    counted = []
    for choice, metros in (("some", CHOSEN_METROS), ("all", ())):
        own = type(PARAMS)(**{**PARAMS.__dict__, "property_type": "line", "metros": metros})
        counted.append(tidy.select_rows(rows, own).groupBy(F.lit(choice).alias("choice"), "metro").agg(F.count(F.lit(1)).alias("n")))
    return counted[0].unionByName(counted[1])


_CHOSEN = ", ".join(f"'{m}'" for m in CHOSEN_METROS)
SQL["chosen_metro_rows"] = f"""
WITH m AS (SELECT n_name AS metro, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
SELECT 'some' AS choice, metro, n FROM m WHERE metro IN ({_CHOSEN}) UNION ALL SELECT 'all', metro, n FROM m"""


# --- sinks ----------------------------------------------------------------------


@query
def allocation_export(spark, folder):
    """The allocation through CSV, with the unit of every column in its header."""
    place = f"{landing.landing_folder(spark)}/allocation"
    display = decide.display_table(decided(spark, folder, ci_level=90).qualifying, 90)
    tables.export_allocation(display, place, 90)
    back = spark.read.csv(place, header=True)
    return back.select(*[F.col(c) if c in ("zip", "metro") else F.col(c).cast("bigint" if c == "rank" else "double").alias(c) for c in back.columns])


_HEADERS = {"rank": "rank", "zip": "zip", "metro": "metro", **decide.export_names(90)}
SQL["allocation_export"] = "SELECT " + ", ".join(f"{a} AS {b}" for a, b in _HEADERS.items()) + f" FROM ({SQL['display_table']})"


@query
def guarded_writes(spark, folder):
    """Rows of a table that was written, and the error for one that would be left empty."""
    place = landing.landing_folder(spark)
    rows = bind.table(spark, folder, "supplier")
    return outcomes(
        spark,
        {
            "rows": lambda: tables.write_table(rows, f"{place}/a").count(),
            "no rows": lambda: tables.write_table(rows.filter("s_suppkey < 0"), f"{place}/b").count(),
            "version refused": lambda: tables.publish(rows.filter("s_suppkey < 0"), f"{place}/c", "v1", check=lambda df: contracts.require_rows(df, "c")),
        },
    )


SQL["guarded_writes"] = """
SELECT 'rows' AS attempt, CAST(count(*) AS VARCHAR) AS outcome FROM supplier
UNION ALL SELECT 'no rows', 'MissingInputError' UNION ALL SELECT 'version refused', 'MissingInputError'"""


@query
def stored_order(spark, folder):
    """Rows of the stored panel and how many stand before a smaller key in their file."""
    place = f"{landing.landing_folder(spark)}/ordered"
    tables.write_table(bound_panel(spark, folder), place, ["zip", "month"])
    read = spark.read.parquet(place).select("zip", "month", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = F.lag(F.struct("zip", "month")).over(Window.partitionBy("file").orderBy("at"))
    return read.select((before > F.struct("zip", "month")).alias("wrong")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("wrong").alias("out_of_order"))


SQL["stored_order"] = f"SELECT count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM ({SQL['panel_join']})"


# --- contracts ------------------------------------------------------------------


@query
def schema_drift(spark, folder):
    """Expected columns that a table lacks, with the error that a load would end in."""
    rows = bind.table(spark, folder, "supplier")
    expected = ["s_suppkey", "s_acctbal", "s_metro", "s_since"]
    lacking = spark.createDataFrame([(c,) for c in contracts.column_drift(rows, expected)], "lacking string")
    error = outcome(lambda: contracts.require_columns(rows, expected, "supplier"))
    fine = outcome(lambda: len(contracts.require_columns(rows, expected[:2], "supplier").select(*expected[:2]).columns))
    total = rows.agg(F.count(F.lit(1)))
    return lacking.select("lacking", F.lit(error).alias("load"), F.lit(fine).alias("found"), total.scalar().alias("rows"))


SQL["schema_drift"] = """
SELECT c AS lacking, 'ContractError' AS load, '2' AS found, (SELECT count(*) FROM supplier) AS rows
FROM (VALUES ('s_metro'), ('s_since')) AS v(c)"""


@query
def feature_dictionary(spark, folder):
    """Every column of the feature table with whether it is documented and has values."""
    table = bound_features(spark, folder)
    documented = features.document(table.select(*table.columns), PARAMS)
    entries = features.dictionary_table(spark, documented)
    known = F.col("comment").isNotNull() & (F.length("comment") > 0) & F.col("formula").isNotNull()
    counts = table.agg(*[F.count(c).alias(c) for c in table.columns])
    filled = counts.unpivot([], list(table.columns), "column_name", "values")
    return entries.join(filled, "column_name").select("column_name", known.alias("documented"), "values")


SQL["feature_dictionary"] = with_(FEATURES, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, true AS documented, count({c}) AS \"values\" FROM features" for c in _ALL))


@query
def history_guard(spark, folder):
    """Folds of a long enough history, and the errors of a short one and of a table without a split."""
    table = bound_features(spark, folder)
    return outcomes(
        spark,
        {
            "enough": lambda: len(split.rolling_folds(table, PARAMS, 5)),
            "too short": lambda: split.rolling_folds(table, PARAMS, 100_000),
            "no split": lambda: split.rolling_folds(table.drop("split"), PARAMS, 5),
            "no test rows": lambda: split.require_filled_folds(table.filter("split = 'none'"), split.rolling_folds(table, PARAMS, 5)),
            "train rows": lambda: table.filter("split = 'train'").count(),
        },
    )


SQL["history_guard"] = f"""
SELECT 'enough' AS attempt, '5' AS outcome UNION ALL SELECT 'too short', 'ContractError' UNION ALL SELECT 'no split', 'ContractError'
UNION ALL SELECT 'no test rows', 'ContractError'
UNION ALL SELECT 'train rows', CAST(n AS VARCHAR) FROM ({SQL["category_counts"]}) WHERE split = 'train'"""


@query
def fold_overlap(spark, folder):
    """Rows of every fold by role, and rows that would be in both."""
    table = bound_features(spark, folder)
    rows = stage(unflagged(split.assign_folds(table, split.rolling_folds(table, PARAMS, MODEL.folds))).select("fold", "zip", "month", "role"), "folds")
    keys = ["fold", "zip", "month"]
    both = rows.filter("role = 'train'").select(*keys).intersect(rows.filter("role = 'val'").select(*keys))
    shared = both.groupBy("fold").agg(F.count(F.lit(1)).alias("shared"))
    sizes = rows.groupBy("fold").agg(F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "val").alias("n_val"))
    return sizes.join(shared, "fold", "left").withColumn("shared", F.coalesce("shared", F.lit(0).cast("bigint")))


SQL["fold_overlap"] = with_(FOLDS, """
SELECT f.fold, (SELECT count(*) FROM fitted t WHERE t.fold = f.fold) AS n_train,
  (SELECT count(*) FROM held h WHERE h.fold = f.fold) AS n_val, CAST(0 AS BIGINT) AS shared FROM folds f""")


# --- texts ----------------------------------------------------------------------


@query
def concentration_text(spark, folder):
    """The warning of a budget that goes to few places: here to the highest ranked one alone."""
    made = decided(spark, folder)
    first = decide.allocate(made.qualifying.filter("rank = 1").drop("weight", "allocation"), 1_000_000.0)
    few = decide.concentration_note(decide.concentration(decide.display_table(first, 80))).withColumn("choice", F.lit("one"))
    all_ = decide.concentration_note(decide.concentration(decide.display_table(made.qualifying, 80))).withColumn("choice", F.lit("all"))
    return few.unionByName(all_).select("choice", "funded", "concentrated", F.col("note").isNotNull().alias("noted"))


SQL["concentration_text"] = with_(decided_sql(), """
SELECT 'one' AS choice, count(*) AS funded, count(*) > 0 AS concentrated, count(*) > 0 AS noted FROM given WHERE rank = 1
UNION ALL SELECT 'all', count(*) FILTER (allocation > 0), coalesce(max(weight) * 100 >= 25, false), coalesce(max(weight) * 100 >= 25, false) FROM given""")


@query
def spoken_values(spark, folder):
    """Prices and shares as texts, with a dash where there is none."""
    rows = bound_features(spark, folder).select("zip", "month", F.floor("median_sale_price").alias("price"), F.round("sold_above_list", 2).alias("share"))
    missing = F.col("zip").endswith("3")
    return rows.select(
        "zip",
        "month",
        money(F.when(~missing, F.col("price"))).alias("price_text"),
        percent(F.when(~missing, F.col("share")), 0).alias("share_text"),
    )


SQL["spoken_values"] = with_(FEATURES, """
SELECT zip, month, CASE WHEN zip LIKE '%3' OR median_sale_price IS NULL THEN '—' ELSE '$' || format('{:,}', floor(median_sale_price)::BIGINT) END AS price_text,
  CASE WHEN zip LIKE '%3' OR sold_above_list IS NULL THEN '—' ELSE CAST(CAST(round(round(sold_above_list, 2) * 100) AS BIGINT) AS VARCHAR) || '%' END AS share_text
FROM features""")
