"""Exact ordering operators that never hold an unbounded group in one task.

A plain window puts a whole group into one task. That is used only where every
group was counted first and is below ``max_group`` rows. Beyond it the rows are
range-partitioned on (group, order), written once with their slice number, and
each slice adds the total of the slices before it. Both ways give the same
numbers; a group of any size is spread over many tasks in the second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelkit.staging import stage

# Rows of one group that a single task may hold (narrow rows, sorted, spillable).
MAX_GROUP_ROWS = 1_000_000
LIMIT_SETTING = "spark.panelkit.maxGroupRows"

SLICE = "_slice"


def group_limit(spark: SparkSession, max_group: int | None = None, default: int = MAX_GROUP_ROWS) -> int:
    """The limit in force: an argument, else the session setting, else the default."""
    if max_group is not None:
        return max_group
    return int(spark.conf.get(LIMIT_SETTING, str(default)))


def group_sizes(df: DataFrame, by: Sequence[str], max_group: int) -> tuple[int, int]:
    """(rows in total, an upper bound of the largest group).

    The row count of a written table comes from its footers; groups are only
    counted when that alone does not settle the question.
    """
    total = df.count()
    if not by or total <= max_group:
        return total, total
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return total, int(sizes.agg(F.max("n")).first()[0] or 0)


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    weight: Column | None = None,
    name: str = "running",
    max_group: int | None = None,
) -> DataFrame:
    """Inclusive running sum of ``weight`` (default 1) in a total order per group.

    The size check reads ``df`` once more, so pass a staged or cheap frame.
    """
    weight = F.lit(1) if weight is None else weight
    max_group = group_limit(df.sparkSession, max_group)
    total, largest = group_sizes(df, by, max_group)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    if largest <= max_group:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(*up_to_here)
        return df.withColumn(name, F.sum(weight).over(window).cast("bigint"))

    slices = max(2, 2 * -(-total // max_group))
    cut = stage(
        df.repartitionByRange(slices, *[F.col(c) for c in by], *order).withColumn(
            SLICE, F.spark_partition_id()
        ),
        "slices",
    )
    # One row per (group, slice): at most ``slices`` rows of any group.
    before = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*by, SLICE)
        .agg(F.sum(weight).alias("_slice_sum"))
        .withColumn("_before", F.coalesce(F.sum("_slice_sum").over(before), F.lit(0)))
        .drop("_slice_sum")
    )
    inside = Window.partitionBy(*by, SLICE).orderBy(*order).rowsBetween(*up_to_here)
    local = cut.withColumn("_local", F.sum(weight).over(inside))
    keys = [*by, SLICE]
    match = [local[k].eqNullSafe(offsets[k]) for k in keys]
    joined = local.join(offsets, match, "inner")
    return joined.select(
        *[local[c] for c in df.columns],
        (F.col("_local") + F.col("_before")).cast("bigint").alias(name),
    )


def position(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    name: str = "rank",
    max_group: int | None = None,
) -> DataFrame:
    """Dense position 1..n in a total order, per group."""
    return running_total(df, order, by, None, name, max_group)


def average_ranks(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    name: str,
    max_group: int | None = None,
) -> DataFrame:
    """Tie-averaged rank of ``value`` within each group, the same at every size.

    A missing value has no rank and does not count; a missing group key is a group.
    """
    max_group = group_limit(df.sparkSession, max_group)
    _, largest = group_sizes(df, by, max_group)
    if largest <= max_group:
        ordered = Window.partitionBy(*by).orderBy(value)
        tied = Window.partitionBy(*by, value)
        rank = F.rank().over(ordered) + (F.count(F.lit(1)).over(tied) - 1) / F.lit(2.0)
        missing = F.count_if(F.col(value).isNull()).over(Window.partitionBy(*by))
        return df.withColumn(name, F.when(F.col(value).isNotNull(), (rank - missing).cast("double")))
    known, unknown = df.filter(F.col(value).isNotNull()), df.filter(F.col(value).isNull())
    ranked = _sliced_average_ranks(known, value, by, name, max_group)
    return ranked.unionByName(unknown.withColumn(name, F.lit(None).cast("double")))


def _sliced_average_ranks(df: DataFrame, value: str, by: Sequence[str], name: str, max_group: int) -> DataFrame:
    """Average ranks over range slices; equal values may lie in any number of slices.

    Inside a slice ranks are local. Only the lowest and the highest value of a slice can go
    on elsewhere, so the small table of slices carries, for both, where its ties begin and
    how many there are in all. Rows meet it by slice, never by value.
    """
    spread = [F.col(c) for c in by] + [F.col(value), F.xxhash64(*df.columns)]
    slices = max(2, 2 * -(-df.count() // max_group))
    cut = stage(df.repartitionByRange(slices, *spread).withColumn(SLICE, F.spark_partition_id()), "slices")
    slice_of = Window.partitionBy(*by, SLICE)
    lowest, highest = F.min(value).over(slice_of), F.max(value).over(slice_of)
    counted = cut.groupBy(*by, SLICE, value).agg(F.count(F.lit(1)).alias("_t"))
    sized = counted.withColumns({"_n": F.sum("_t").over(slice_of), "_low": lowest, "_high": highest})
    # at most two rows per (group, slice)
    ends = stage(sized.filter((F.col(value) == F.col("_low")) | (F.col(value) == F.col("_high"))), "ends")
    earlier = Window.partitionBy(*by).orderBy(SLICE).rangeBetween(Window.unboundedPreceding, -1)
    once = F.when(F.col(value) == F.col("_low"), F.col("_n")).otherwise(0)
    ties = ends.withColumn("_before", F.coalesce(F.sum(once).over(earlier), F.lit(0)))
    # a value that begins in a slice as its highest stands before that slice's last _t rows
    everywhere = Window.partitionBy(*by, value)
    starts = F.when(F.col(value) == F.col("_high"), F.col("_before") + F.col("_n") - F.col("_t")).otherwise(F.col("_before"))
    middle = (F.min(starts).over(everywhere) + (F.sum("_t").over(everywhere) + 1) / F.lit(2.0)).cast("double")
    placed = ties.withColumn("_middle", middle).groupBy(*by, SLICE).agg(
        F.min("_before").alias("_before"),
        F.min(value).alias("_low"), F.max(value).alias("_top"),
        F.min_by("_middle", value).alias("_low_rank"), F.max_by("_middle", value).alias("_top_rank"),
    )
    tied = Window.partitionBy(*by, SLICE, value)
    local = cut.withColumn("_local", F.rank().over(slice_of.orderBy(value)) + (F.count(F.lit(1)).over(tied) - 1) / F.lit(2.0))
    keys = {k: f"_key{i}" for i, k in enumerate((*by, SLICE))}
    named = placed.withColumnsRenamed(keys)
    joined = local.join(named, [F.col(k).eqNullSafe(F.col(v)) for k, v in keys.items()], "inner")
    rank = (
        F.when(F.col(value) == F.col("_low"), F.col("_low_rank"))
        .when(F.col(value) == F.col("_top"), F.col("_top_rank"))
        .otherwise((F.col("_before") + F.col("_local")).cast("double"))
    )
    return joined.select(*df.columns, rank.alias(name))
