"""Temporal splits and gapped rolling folds."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import PanelParams
from panelkit.errors import ContractError


class Fold(NamedTuple):
    fold: int
    val_month: datetime.date
    train_start: datetime.date
    train_end: datetime.date


def shift_month(month: datetime.date, months: int) -> datetime.date:
    """First day of the month ``months`` away from a first day of month."""
    years, rest = divmod(month.year * 12 + month.month - 1 + months, 12)
    return datetime.date(years, rest + 1, 1)


def recent_months(df: DataFrame, count: int) -> list[datetime.date]:
    """Last ``count`` distinct months of the frame, ascending.

    Only ``count`` dates reach the driver, whatever the size of the frame.
    """
    rows = df.select("month").distinct().orderBy(F.desc("month")).limit(count).collect()
    return sorted(r["month"] for r in rows)


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("target").isNotNull())


def assign_split(features: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Add ``split``: test = last labelled months, train = earlier, live = no label.

    ``holdout_gap`` months between train and test are tagged 'gap'; the default
    of 0 leaves none.
    """
    n = params.holdout_months
    months = recent_months(labelled(features), n + 1)
    if not months:
        raise ContractError("no labelled rows: nothing to split")
    if len(months) <= n:
        raise ContractError(f"only {len(months)} labelled months, cannot hold out {n}")
    first_test = months[-n]
    gap_from = shift_month(first_test, -params.holdout_gap)
    split = (
        F.when(F.col("target").isNull(), "live")
        .when(F.col("month") >= F.lit(first_test), "test")
        .when(F.col("month") >= F.lit(gap_from), "gap")
        .otherwise("train")
    )
    return features.withColumn("split", split)


def rolling_folds(
    features: DataFrame, params: PanelParams = PanelParams(), n_folds: int = 5
) -> list[Fold]:
    """Fold i validates on the i-th of the last ``n_folds`` train months.

    Its train window is at most ``train_window_months`` long and ends
    ``cv_gap_months`` before the validation month.
    """
    if "split" not in features.columns:
        raise ContractError("the feature table has no `split` column: assign the split first")
    months = recent_months(features.filter(F.col("split") == "train"), n_folds)
    if len(months) < n_folds:
        raise ContractError(f"only {len(months)} train months for {n_folds} folds")
    folds = []
    for i, month in enumerate(months):
        end = shift_month(month, -params.cv_gap_months)
        folds.append(Fold(i + 1, month, shift_month(end, 1 - params.train_window_months), end))
    return folds


def fold_table(spark: SparkSession, folds: Sequence[Fold]) -> DataFrame:
    return spark.createDataFrame(
        [tuple(f) for f in folds], "fold int, val_month date, train_start date, train_end date"
    )


def assign_folds(features: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """One row per (row, fold it takes part in) with its ``role``.

    The handful of folds is an array literal, and each row keeps the folds whose
    month range holds it: an interval join without a join or a shuffle.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(f.fold).alias("fold"),
                F.lit(f.val_month).alias("val_month"),
                F.lit(f.train_start).alias("train_start"),
                F.lit(f.train_end).alias("train_end"),
            )
            for f in folds
        ]
    )
    month = F.col("month")
    hits = F.filter(
        entries,
        lambda f: (month == f["val_month"]) | month.between(f["train_start"], f["train_end"]),
    )
    return (
        features.filter(F.col("split") == "train")
        .select("*", F.explode(hits).alias("_f"))
        .withColumns(
            {
                "fold": F.col("_f.fold"),
                "val_month": F.col("_f.val_month"),
                "role": F.when(F.col("month") == F.col("_f.val_month"), "val").otherwise("train"),
            }
        )
        .drop("_f")
    )


def fold_sizes(features: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """Train and validation rows of every fold, in one pass."""
    rows = assign_folds(features, folds)
    return rows.groupBy("fold", "val_month").agg(
        F.count_if(F.col("role") == "train").alias("n_train"),
        F.count_if(F.col("role") == "val").alias("n_val"),
    )


def require_filled_folds(features: DataFrame, folds: Sequence[Fold]) -> None:
    filled = {
        r["fold"]
        for r in fold_sizes(features, folds).collect()
        if r["n_train"] > 0 and r["n_val"] > 0
    }
    empty = [str(f.val_month) for f in folds if f.fold not in filled]
    if empty:
        raise ContractError(f"empty fold for validation month(s) {empty}")


def rolling_window(features: DataFrame, months: int) -> DataFrame:
    """Rows of the most recent ``months`` labelled months."""
    rows = labelled(features)
    recent = recent_months(rows, months)
    if not recent:
        return rows
    return rows.filter(F.col("month") >= F.lit(recent[0]))


def drop_flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows without any of the flags; a missing flag counts as not set."""
    for name in flags:
        if name in df.columns:
            df = df.filter(~F.coalesce(name, F.lit(False)))
    return df
