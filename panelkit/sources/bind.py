"""Test tables in the roles of the three panel sources (see FIXTURES.md part 3).

The macro values are divided by 10,000 so that they look like rates, and the stub
forecast reacts to the rate, so that a rate scenario changes the ranking.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import PanelParams
from panelkit.functions.calendar import month_floor, month_index
from panelkit.functions.keys import pad_key
from panelkit.operators.trailing import trailing_cells

# Fixed values of the binding.
DUPLICATED_MONTH = datetime.date(1997, 6, 1)
GAP_MONTH = datetime.date(1998, 4, 1)
KEYLESS_MONTH = datetime.date(1996, 9, 1)
UNPRICED_MONTH = datetime.date(1997, 11, 1)
MACRO_PRIORITIES = {
    "1-URGENT": "MORTGAGE30US",
    "2-HIGH": "UNRATE",
    "3-MEDIUM": "CPIAUCSL",
    "4-NOT SPECIFIED": "HOUST",
    "5-LOW": "HOUST",
}
BLANK_SERIES, BLANK_MONTH = "UNRATE", datetime.date(1999, 10, 1)
PARAMS = PanelParams(property_type="O")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tracker(spark: SparkSession, folder: str, property_type: str | None = None) -> DataFrame:
    """Raw tracker: trailing windows, single-month windows of 1996, duplicates, bad keys, gaps.

    A line item belongs to the three windows that end in its ship month and the
    two months after; one of 1996 also to a single-month window. Dates are only computed
    per cell. With ``property_type`` only rows of that type are made.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_linestatus").alias("property_type"), month_index("l_shipdate").alias("ship"),
        "l_extendedprice", "l_quantity", "l_discount", "l_returnflag",
    )
    if property_type is not None:
        lines = lines.filter(F.col("property_type") == property_type)
    # one row: the first month in which a whole window ends, and the last month that is over
    dates = table(spark, folder, "lineitem").agg(
        F.count(F.lit(1)).alias("rows"),
        month_index(F.min("l_shipdate")).alias("first"),
        month_index(F.date_add(F.max("l_shipdate").cast("date"), 1)).alias("after"),
    )
    ends = dates.first()
    first, last = (ends["first"] or 0) + 2, (ends["after"] or 0) - 1
    made = trailing_cells(
        lines,
        ["l_suppkey", "property_type"],
        "ship",
        {"median_sale_price": "l_extendedprice", "median_dom": "l_quantity"},
        {
            "inventory": F.col("l_quantity"),
            "_new": (F.col("l_returnflag") == "N").cast("double"),
            "_kept": 1 - F.col("l_discount"),
            "_full": (F.col("l_discount") == 0).cast("double"),
        },
        spans=(3, 1),
        rows=ends["rows"],
    )
    single = (F.col("span") == 1) & (F.floor((F.col("end_month") - 1) / 12) == 1996)
    cells = made.filter(F.col("end_month").between(first, last) & ((F.col("span") == 3) | single)).select(
        "l_suppkey", "property_type", "end_month", "span", "median_sale_price", "median_dom",
        F.col("n").cast("double").alias("homes_sold"),
        "inventory",
        F.col("_new").alias("new_listings"),
        (F.col("_kept") / F.col("n")).alias("avg_sale_to_list"),
        (F.col("_full") / F.col("n")).alias("sold_above_list"),
    )
    gap_month = GAP_MONTH.year * 12 + GAP_MONTH.month
    gap = (F.col("end_month") == gap_month) & (F.col("l_suppkey") % 7 == 0)
    years, month = F.floor((F.col("end_month") - 1) / 12), (F.col("end_month") - 1) % 12 + 1
    ends_in = F.make_date(years.cast("int"), month.cast("int"), F.lit(1))

    def published(price: Column, digits: Column):
        return F.struct(
            F.concat(F.lit("Zip Code: "), digits).alias("region_zip"),
            F.add_months("month", 1 - F.col("span")).alias("period_begin"),
            F.last_day("month").alias("period_end"),
            price.alias("median_sale_price"),
        )

    def also(condition: Column, row: Column) -> Column:
        return F.filter(F.array(row), lambda _: condition)

    # Text and dates of a published row come out of the generator, so a later
    # filter on them is evaluated per cell and not pushed down to every line.
    price, digits = F.col("median_sale_price"), F.col("l_suppkey").cast("string")
    in_month = lambda m: F.col("month") == F.lit(m)
    rows_of_cell = F.concat(
        F.array(published(price, digits)),
        also(in_month(DUPLICATED_MONTH), published(price + 1.0, digits)),
        also(in_month(KEYLESS_MONTH) & (F.col("l_suppkey") % 11 == 0), published(price, F.lit("unknown"))),
        also(in_month(UNPRICED_MONTH) & (F.col("l_suppkey") % 13 == 0), published(F.lit(None).cast("double"), digits)),
    )
    others = [
        "property_type",
        "homes_sold",
        "inventory",
        "new_listings",
        "median_dom",
        "avg_sale_to_list",
        "sold_above_list",
    ]
    return (
        cells.filter(~gap)
        .withColumn("month", ends_in)
        .select(*others, F.inline(rows_of_cell))
        .withColumn("price_drops", F.lit(None).cast("double"))
    )


def index_long(spark: SparkSession, folder: str) -> DataFrame:
    """Index observations per (supplier, ship month), before any pivoting."""
    published = table(spark, folder, "supplier").filter("s_acctbal > 1000").select("s_suppkey")
    per_month = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", month_floor("l_shipdate").alias("month"))
        .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("zhvi"))
    )
    return per_month.join(
        published, per_month["l_suppkey"] == published["s_suppkey"], "left_semi"
    )


def index_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The index in its landed shape: one row per region, one column per month end."""
    lines = table(spark, folder, "lineitem")
    first, last = lines.agg(
        month_floor(F.min("l_shipdate")), month_floor(F.max("l_shipdate"))
    ).first()
    span = (last.year - first.year) * 12 + last.month - first.month
    starts = [(first.year * 12 + first.month - 1 + i) for i in range(span + 1)]
    months = [datetime.date(m // 12, m % 12 + 1, 1) for m in starts]
    labels = [
        (datetime.date((m + 1) // 12, (m + 1) % 12 + 1, 1) - datetime.timedelta(days=1)).isoformat()
        for m in starts
    ]
    pivoted = (
        index_long(spark, folder)
        .groupBy(F.col("l_suppkey").cast("string").alias("RegionName"))
        .pivot("month", months)
        .agg(F.max("zhvi"))
    )
    wide = pivoted.toDF("RegionName", *labels)
    # some regions come twice, under another spelling of their key and with lower values
    again = wide.filter("CAST(RegionName AS BIGINT) % 17 = 0").select(
        F.lpad("RegionName", 5, "0").alias("RegionName"), *[(F.col(f"`{c}`") - 1).alias(c) for c in labels]
    )
    return wide.unionByName(again.filter("length(RegionName) = 5"))


def index(spark: SparkSession, folder: str) -> DataFrame:
    """Tidy index, straight from the long form (no wide detour)."""
    return index_long(spark, folder).select(
        pad_key(F.col("l_suppkey").cast("string")).alias("zip"), "month", "zhvi"
    )


def macro_observations(spark: SparkSession, folder: str) -> DataFrame:
    """(series, date, value text): weekly means of the order value, '.' = missing."""
    names = F.create_map(*[F.lit(x) for item in MACRO_PRIORITIES.items() for x in item])
    weekly = (
        table(spark, folder, "orders")
        .filter(F.col("o_orderpriority").isin(list(MACRO_PRIORITIES)))
        .groupBy(
            F.try_element_at(names, F.col("o_orderpriority")).alias("series"),
            F.to_date(F.date_trunc("week", "o_orderdate")).alias("date"),
        )
        .agg((F.avg("o_totalprice") / 10000).alias("value"))
    )
    blank = (F.col("series") == BLANK_SERIES) & (month_floor("date") == F.lit(BLANK_MONTH))
    return weekly.select(
        "series",
        "date",
        F.when(blank, ".").otherwise(F.col("value").cast("string")).alias("value"),
    )


def metro_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(l_suppkey, metro) of every line: the metro of a line is its customer's nation.

    Lines are shuffled once, to their orders; an order or customer that holds a
    large share of them is split by Spark, because its partner is a single row.
    """
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("metro"))
    homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "metro")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_suppkey", "metro")


def region_zip() -> Column:
    return F.concat(F.lit("Zip Code: "), F.col("l_suppkey").cast("string")).alias("region_zip")


def metro_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per (region, metro)."""
    counted = metro_lines(spark, folder).groupBy("l_suppkey", "metro").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(region_zip(), "metro", "n")


def tracker_with_metros(spark: SparkSession, folder: str) -> DataFrame:
    """The tracker as it lands, with a row of another kind per line that names its metro."""
    named = metro_lines(spark, folder).select(region_zip(), "metro", F.lit("line").alias("property_type"))
    return tracker(spark, folder).unionByName(named, allowMissingColumns=True)


def exclusion_values(spark: SparkSession, folder: str) -> DataFrame:
    """Raw exclusion list: suppliers in debt plus four awkward entries."""
    awkward = ["12a", " 7 ", "8.0", ""]
    debtors = (
        table(spark, folder, "supplier")
        .filter("s_acctbal < 0")
        .select(F.col("s_suppkey").cast("string").alias("value"))
    )
    return debtors.unionByName(spark.createDataFrame([(v,) for v in awkward], "value string"))


def geometries(spark: SparkSession, folder: str) -> DataFrame:
    """A unit square per supplier around (nation, supplier % 90); one in ten has none.

    Every third is a multi-polygon, and every third a collection with a point beside
    the square.
    """
    x, y = F.col("s_nationkey").cast("double"), (F.col("s_suppkey") % 90).cast("double")
    corners = [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5), (-0.5, -0.5)]
    ring = F.array(*[F.array(x + F.lit(dx), y + F.lit(dy)) for dx, dy in corners])

    def shape(kind: str, member: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), value.alias(member))

    square = shape("Polygon", "coordinates", F.array(ring))
    several = shape("MultiPolygon", "coordinates", F.array(F.array(ring)))
    beside = shape("Point", "coordinates", F.array(x + 0.75, y - 0.75))
    parts = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), F.to_json(square), F.lit(","), F.to_json(beside), F.lit("]}"))
    third = F.col("s_suppkey") % 3
    return (
        table(spark, folder, "supplier")
        .filter("s_suppkey % 10 <> 6")
        .select(
            pad_key(F.col("s_suppkey").cast("string")).alias("id"),
            F.when(third == 0, F.to_json(square)).when(third == 1, F.to_json(several)).otherwise(parts).alias("geometry"),
        )
    )


def stub_predictions(features: DataFrame) -> DataFrame:
    """Deterministic scorer: bands around a tenth of the 3-month momentum.

    The forecast falls by a hundredth of the 3-month rate change, so a rate
    scenario has an effect. Stands in for a fitted model in the decision layer.
    """
    p50 = F.coalesce(F.col("price_mom_3m"), F.lit(0.0)) / 10 - 0.01 * F.coalesce(
        F.col("mortgage_delta_3m"), F.lit(0.0)
    )
    half80 = 0.002 + F.col("homes_sold") / 10000
    made = features.withColumns({"p50": p50, "_h80": half80, "_h90": 1.6 * half80})
    return made.withColumns(
        {
            "point": F.col("p50"),
            "p05": F.col("p50") - F.col("_h90"),
            "p10": F.col("p50") - F.col("_h80"),
            "p90": F.col("p50") + F.col("_h80"),
            "p95": F.col("p50") + F.col("_h90"),
            "ci80_width": 2 * F.col("_h80"),
            "ci90_width": 2 * F.col("_h90"),
        }
    ).drop("_h80", "_h90")
