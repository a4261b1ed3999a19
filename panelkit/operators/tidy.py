"""From landed source shapes to tidy (zip, month) tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import TRACKER_METRICS, PanelParams
from panelkit.errors import ContractError
from panelkit.functions.calendar import is_whole_window, month_floor
from panelkit.functions.keys import leading_digits_key, trailing_digits_key
from panelkit.functions.numbers import as_number, flag


def rename_logical(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Physical column names to logical ones; ``mapping`` is logical -> physical."""
    return df.withColumnsRenamed({physical: logical for logical, physical in mapping.items()})


def select_rows(df: DataFrame, params: PanelParams) -> DataFrame:
    """Rows of the configured property type and, if any are listed, metros."""
    kept = df.filter(F.col("property_type") == params.property_type)
    if params.metros:
        kept = kept.filter(F.col("metro").isin(list(params.metros)))
    return kept


def _tracker_steps() -> dict[str, F.Column]:
    whole = flag(is_whole_window("period_begin", "period_end"))
    keyed = whole & trailing_digits_key("region_zip").isNotNull()
    priced = keyed & F.col("median_sale_price").isNotNull()
    return {"whole_window": whole, "keyed": keyed, "priced": priced}


def tidy_tracker(df: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Whole three-month windows, keyed, priced and unique on (zip, month).

    Of several rows for a cell the last in the total order of all values wins,
    and a missing value counts as the largest. ``row_number() = 1`` lets Spark
    cut each group down before the shuffle.
    """
    kept = df.filter(_tracker_steps()["priced"])
    cells = kept.withColumns(
        {
            "zip": trailing_digits_key("region_zip"),
            "month": month_floor("period_end"),
        }
    )
    order = [F.col(c).desc_nulls_first() for c in ("period_end", *TRACKER_METRICS)]
    best = Window.partitionBy("zip", "month").orderBy(*order)
    return (
        cells.withColumn("_n", F.row_number().over(best))
        .filter(F.col("_n") == 1)
        .select(
            "zip",
            "month",
            *TRACKER_METRICS,
            low_volume_flag(params.low_volume_threshold).alias("low_volume"),
        )
    )


def low_volume_flag(threshold: int):
    """Thin cells are flagged and kept; a missing count is a thin cell."""
    return F.coalesce("homes_sold", F.lit(0.0)) < threshold


def tracker_funnel(df: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Rows in and out of every tidy step, in one pass over the raw table."""
    steps = {"property_type": F.col("property_type") == params.property_type}
    steps |= {n: steps["property_type"] & c for n, c in _tracker_steps().items()}
    cell = [trailing_digits_key("region_zip").alias("zip"), month_floor("period_end").alias("month")]
    per_cell = df.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("raw"),
        *[F.count_if(flag(c)).alias(n) for n, c in steps.items()],
    )
    totals = per_cell.agg(
        F.sum("raw").alias("raw"),
        *[F.sum(n).alias(n) for n in steps],
        F.count_if(F.col("priced") > 0).alias("dedup"),
    )
    names = [*steps, "dedup"]
    rows = [
        F.struct(
            F.lit(i + 1).alias("step_no"),
            F.lit(name).alias("step"),
            F.col((["raw", *names])[i]).alias("rows_in"),
            F.col(name).alias("rows_out"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*rows)))


def drop_empty_columns(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Drop the candidate columns that are NULL on every row (one aggregate)."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return df
    filled = df.agg(*[F.count(c).alias(c) for c in present]).first()
    return df.drop(*[c for c in present if filled[c] == 0])


def tidy_wide(
    df: DataFrame,
    key: str = "RegionName",
    month_pattern: str = r"^\d{4}-\d{2}-\d{2}$",
    value: str = "zhvi",
) -> DataFrame:
    """Wide month-end columns to (zip, month, value), unique and without gaps.

    Input order does not exist in Spark, so of duplicate cells the highest value
    is kept.
    """
    months = [c for c in df.columns if re.fullmatch(month_pattern, c)]
    if not months:
        raise ContractError("no month columns in the wide table: wrong file or new layout")
    return (
        df.select(key, *[as_number(F.col(f"`{c}`")).alias(c) for c in months])
        .unpivot([key], months, "month_end", "value")
        .select(
            leading_digits_key(key).alias("zip"),
            month_floor(F.to_date("month_end")).alias("month"),
            "value",
        )
        .dropna(subset=["zip", "value"])
        .groupBy("zip", "month")
        .agg(F.max("value").alias(value))
    )


def tidy_macro(
    observations: DataFrame, series: Sequence[str], fill: bool = True, spine: bool = False
) -> DataFrame:
    """(series, date, value text) to one row per month, one column per series.

    The pivot is one conditional aggregate, hence a single map-side combined
    shuffle; a month has a row if any of the series has a value in it. With ``spine``
    every month between the first and the last has one, so that a month in which nothing
    was published is filled like any other gap.
    """
    monthly = (
        observations.select(
            "series", month_floor("date").alias("month"), as_number("value").alias("value")
        )
        .filter(F.col("value").isNotNull())
        .groupBy("month")
        .agg(*[F.avg(F.when(F.col("series") == s, F.col("value"))).alias(s) for s in series])
        .filter(F.coalesce(*series).isNotNull())
    )
    if spine:
        monthly = on_calendar(monthly)
    return fill_interior_gaps(monthly, series) if fill else monthly


def on_calendar(df: DataFrame, month: str = "month") -> DataFrame:
    """The rows of a monthly table and an empty one for every month it skips."""
    ends = df.agg(F.min(month).alias("_first"), F.max(month).alias("_last")).filter(F.col("_first").isNotNull())
    calendar = ends.select(F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 MONTH"))).alias(month))
    return calendar.join(df, month, "left").select(*df.columns)


def fill_interior_gaps(df: DataFrame, columns: Sequence[str], month: str = "month") -> DataFrame:
    """Repeat the last value through interior gaps; trailing months stay NULL.

    The table has one row per calendar month, and a DATE has fewer than 120,000
    of those, so the single-partition window is bounded by the type.
    """
    upto = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everywhere = Window.orderBy(month).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    filled = {}
    for c in columns:
        last_known = F.max(F.when(F.col(c).isNotNull(), F.col(month))).over(everywhere)
        filled[c] = F.when(F.col(month) <= last_known, F.last(c, ignorenulls=True).over(upto))
    return df.withColumns(filled)


def metro_counts(df: DataFrame) -> DataFrame:
    """Rows per (region, metro); partial counts are combined by Spark."""
    return (
        df.dropna(subset=["region_zip", "metro"])
        .groupBy("region_zip", "metro")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def resolve_metro(counts: DataFrame) -> DataFrame:
    """One metro per zip: the most frequent label, ties to the first name."""
    per_label = (
        counts.select(trailing_digits_key("region_zip").alias("zip"), "metro", "n")
        .dropna(subset=["zip", "metro"])
        .groupBy("zip", "metro")
        .agg(F.sum("n").alias("n"))
    )
    best = Window.partitionBy("zip").orderBy(F.desc("n"), F.asc("metro"))
    return (
        per_label.withColumn("_n", F.row_number().over(best))
        .filter(F.col("_n") == 1)
        .select("zip", "metro")
    )
