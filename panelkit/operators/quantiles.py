"""Exact grouped percentiles, safe for groups of any size.

Spark's ``percentile`` keeps the distinct values of a group in one task. Groups
are counted first (a column-pruned, map-side combined pass); the usual case, no
group above ``max_group`` rows, is one ordinary aggregate. Rows of the larger
groups are folded to (group, value, count) and picked out of a distributed
running count instead. Both interpolate linearly and are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ordering import group_limit, running_total
from panelkit.staging import stage

# Groups that may be sent to every task as a filter list.
BROADCAST_GROUPS = 100_000


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def grouped_percentiles(
    df: DataFrame,
    by: Sequence[str],
    percentiles: Mapping[str, tuple[str, float]],
    aggregates: Sequence[Column] = (),
    max_group: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """Group ``df`` by ``by``: ``aggregates`` plus exact percentiles.

    ``percentiles`` maps an output name to (value column, probability). A known
    upper bound of the size of any group, ``at_most``, can save the counting.
    """
    max_group = group_limit(df.sparkSession, max_group)
    plain = [F.percentile(c, F.lit(p)).alias(n) for n, (c, p) in percentiles.items()]
    if at_most is not None and at_most <= max_group:
        return _whole_groups(df, by, [*aggregates, *plain])
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_group)
    hot = stage(sizes.select(*by), "hot_groups")
    hot_count = hot.count()
    if hot_count == 0:
        return _whole_groups(df, by, [*aggregates, *plain])

    listed = F.broadcast(hot) if hot_count <= BROADCAST_GROUPS else hot
    usual = df.join(listed, _null_safe(df, listed, by), "left_anti")
    large = df.join(listed, _null_safe(df, listed, by), "left_semi")
    small_result = _whole_groups(usual, by, [*aggregates, *plain])
    result = large.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *aggregates)
    for value in sorted({c for c, _ in percentiles.values()}):
        wanted = {n: p for n, (c, p) in percentiles.items() if c == value}
        picked = _pick(large, by, value, wanted, max_group)
        match = _null_safe(result, picked, by)
        result = result.join(picked, match, "left").select(
            *[result[c] for c in result.columns], *wanted
        )
    return small_result.unionByName(result.select(*small_result.columns))


def _whole_groups(df: DataFrame, by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """Aggregate groups of checked size.

    Rows are shuffled as they are: a partial ``percentile`` state of a small
    group is larger than its rows.
    """
    return df.repartition(*by).groupBy(*by).agg(*aggregates)


def _pick(
    df: DataFrame, by: Sequence[str], value: str, wanted: Mapping[str, float], max_group: int
) -> DataFrame:
    """Percentiles of one column by selecting order statistics."""
    counts = stage(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_c")),
        "value_counts",
    )
    upto = running_total(counts, [F.col(value)], by, F.col("_c"), "_upto", max_group)
    totals = counts.groupBy(*by).agg(F.sum("_c").alias("_total"))
    upto = upto.join(totals, _null_safe(upto, totals, by)).select(
        *[upto[c] for c in upto.columns], "_total"
    )
    picks, outputs = [], []
    for i, (name, p) in enumerate(wanted.items()):
        place = F.lit(p) * (F.col("_total") - 1)
        for side, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            covers = (F.col("_upto") > at) & (F.col("_upto") - F.col("_c") <= at)
            picks.append(F.max(F.when(covers, F.col(value))).alias(f"_{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_w{i}"))
        low, high, share = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_w{i}")
        outputs.append((low * (1 - share) + high * share).alias(name))
    return upto.groupBy(*by).agg(*picks).select(*by, *outputs)
