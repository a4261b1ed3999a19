"""Profiles of a feature table, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.quantiles import grouped_percentiles


def category_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent of missing values per column, only columns with any, worst first.

    One aggregate counts every column; its single row is turned into rows.
    """
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in columns]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.try_divide((F.col("_n") - F.col(f"`{c}`")) * 100.0, F.col("_n")).alias("missing_pct"),
        )
        for c in columns
    ]
    return (
        counts.select(F.inline(F.array(*rows)))
        .filter(F.col("missing_pct") > 0)
        .orderBy(F.desc("missing_pct"), F.asc("column_name"))
    )


def quality_summary(features: DataFrame, tracker_rows: DataFrame) -> DataFrame:
    """One row: range, keys, rows per split, labels, coverage and flag shares.

    Counts are folded to one row per zip first; the distinct count of zips is
    then a plain count.
    """
    labelled = F.col("target").isNotNull()
    per_zip = features.groupBy("zip").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "test").alias("test_rows"),
        F.count_if(F.col("split") == "live").alias("live_rows"),
        F.count_if(labelled).alias("labelled_rows"),
        F.count_if(F.col("low_volume")).alias("_low"),
        F.count_if(labelled & F.col("target_outlier")).alias("_outlier"),
    )
    source = tracker_rows.agg(F.count(F.lit(1))).scalar()
    sums = ("rows", "train_rows", "test_rows", "live_rows", "labelled_rows", "_low", "_outlier")
    total = per_zip.agg(
        F.min("first_month").alias("first_month"),
        F.max("last_month").alias("last_month"),
        F.count(F.lit(1)).alias("zips"),
        *[F.sum(c).alias(c) for c in sums],
    )
    return total.select(
        "first_month",
        "last_month",
        "zips",
        "rows",
        "train_rows",
        "test_rows",
        "live_rows",
        "labelled_rows",
        F.try_divide("labelled_rows", "rows").alias("labelled_share"),
        F.try_divide(F.col("rows"), source).alias("join_coverage"),
        F.try_divide("_low", "rows").alias("low_volume_share"),
        F.try_divide("_outlier", "labelled_rows").alias("outlier_share"),
    )


def value_percentiles(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    probabilities: Sequence[float],
    max_group: int | None = None,
) -> DataFrame:
    """Linearly interpolated percentiles, named p50, p95, ..."""
    named = {f"p{round(p * 100):02d}": (column, p) for p in probabilities}
    return grouped_percentiles(df, by, named, [F.count(column).alias("n")], max_group)
