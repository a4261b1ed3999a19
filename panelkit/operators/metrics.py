"""Forecast metrics per group and pooled; calibration; drift.

Predictions are one DataFrame with ``prediction``, ``target``, ``month`` and any
label columns (model, fold), so a single query scores every model at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.ordering import average_ranks

# Half of the distance that still counts as the same best value.
BEST_TOLERANCE = 1e-12


def rank_correlation(
    predictions: DataFrame,
    by: Sequence[str],
    left: str = "prediction",
    right: str = "target",
    max_group: int | None = None,
) -> DataFrame:
    """Spearman correlation per group from tie-averaged ranks of the complete pairs.

    A pair with a missing side is left out before anything is ranked. A side that is
    constant has no spread of ranks, and a group without complete pairs has none at
    all: the result is NULL.
    """
    pairs = predictions.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    ranked = average_ranks(pairs, left, by, "_rl", max_group)
    ranked = average_ranks(ranked, right, by, "_rr", max_group)
    spread = F.stddev_pop("_rl") * F.stddev_pop("_rr")
    return ranked.groupBy(*by).agg(
        F.try_divide(F.covar_pop("_rl", "_rr"), F.nullif(spread, F.lit(0.0))).alias("rank_corr")
    )


def group_metrics(
    predictions: DataFrame, by: Sequence[str], max_group: int | None = None
) -> DataFrame:
    """rmse, mae, dir_acc, rank_corr and n per group, plus their raw sums."""
    error = F.col("prediction") - F.col("target")
    hit = F.signum("prediction") == F.signum("target")
    sums = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(error * error).alias("sum_sq"),
        F.sum(F.abs(error)).alias("sum_abs"),
        F.count_if(hit).alias("hits"),
    )
    corr = rank_correlation(predictions, by, max_group=max_group)
    match = [sums[k].eqNullSafe(corr[k]) for k in by]
    return _rates(sums.join(corr, match, "left").select(*[sums[c] for c in sums.columns], "rank_corr"))


def _rates(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "rmse": F.sqrt(F.try_divide("sum_sq", "n")),
            "mae": F.try_divide("sum_abs", "n"),
            "dir_acc": F.try_divide("hits", "n"),
        }
    )


def pooled_metrics(per_group: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pool group metrics: errors weighted by row, rank correlation by group."""
    sums = per_group.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.sum("sum_sq").alias("sum_sq"),
        F.sum("sum_abs").alias("sum_abs"),
        F.sum("hits").alias("hits"),
        F.avg("rank_corr").alias("rank_corr"),
    )
    return _rates(sums)


def metrics_report(
    predictions: DataFrame, labels: Sequence[str] = (), max_group: int | None = None
) -> DataFrame:
    """Per month and, with a NULL month, pooled metrics for each label."""
    per_month = group_metrics(predictions, [*labels, "month"], max_group)
    pooled = pooled_metrics(per_month, labels).withColumn("month", F.lit(None).cast("date"))
    columns = [*labels, "month", "rmse", "mae", "dir_acc", "rank_corr", "n"]
    return per_month.select(*columns).unionByName(pooled.select(*columns))


def mark_best(models: DataFrame, metric: str = "rank_corr") -> DataFrame:
    """Flag the model(s) at the best value of the metric (one row per model)."""
    best = F.max(metric).over(Window.partitionBy())
    return models.withColumn(
        "is_best", F.coalesce(F.abs(F.col(metric) - best) < BEST_TOLERANCE, F.lit(False))
    )


def headline_delta(pooled: DataFrame, model: str, baseline: str, metric: str = "rank_corr"):
    """One row: metric of model and baseline, their difference and the verdict."""
    value = {m: F.max(F.when(F.col("model") == m, F.col(metric))) for m in (model, baseline)}
    return pooled.agg(
        value[model].alias("model_value"), value[baseline].alias("baseline_value")
    ).select(
        F.lit(model).alias("model"),
        F.lit(baseline).alias("baseline"),
        "model_value",
        "baseline_value",
        (F.col("model_value") - F.col("baseline_value")).alias("delta"),
        F.coalesce(F.col("model_value") > F.col("baseline_value"), F.lit(False)).alias("beats"),
    )


# Band label -> (lower column, upper column, nominal coverage).
NOMINAL = {"80": ("p10", "p90", 0.80), "90": ("p05", "p95", 0.90)}
WORST_GAP = 0.10


def interval_coverage(predictions: DataFrame, by: Sequence[str] = ("fold",)) -> DataFrame:
    """Share of targets inside each band per fold (bounds included)."""
    inside = {
        f"coverage_{b}": F.avg(F.col("target").between(F.col(lo), F.col(hi)).cast("double"))
        for b, (lo, hi, _) in NOMINAL.items()
    }
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in inside.items()]
    )


def calibration_table(per_fold: DataFrame) -> DataFrame:
    """Nominal and empirical coverage: the pooled value is the mean of the folds."""
    pooled = per_fold.agg(*[F.avg(f"coverage_{b}").alias(b) for b in NOMINAL])
    rows = [
        F.struct(
            F.lit(b).alias("band"),
            F.lit(nominal).alias("nominal"),
            F.col(f"`{b}`").alias("empirical"),
        )
        for b, (_, _, nominal) in NOMINAL.items()
    ]
    gap = F.col("empirical") - F.col("nominal")
    return (
        pooled.select(F.inline(F.array(*rows)))
        .withColumn("gap", gap)
        .withColumn("beyond_tolerance", F.coalesce(F.abs("gap") > WORST_GAP, F.lit(False)))
    )


def drift_stats(
    window: DataFrame, reference: DataFrame, columns: Sequence[str], top: int = 8
) -> DataFrame:
    """Standardised shift of the mean per feature, largest first.

    One row of means per side; both are unpivoted to one row per feature.
    """

    def moments(df: DataFrame, spread: bool) -> DataFrame:
        parts = [
            F.struct(
                F.avg(c).alias("mean"), (F.stddev_samp(c) if spread else F.lit(None)).alias("sd")
            ).alias(c)
            for c in columns
        ]
        rows = [
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"{c}.mean").alias("mean"),
                F.col(f"{c}.sd").cast("double").alias("sd"),
            )
            for c in columns
        ]
        return df.agg(*parts).select(F.inline(F.array(*rows)))

    now = moments(window, False).select("feature", F.col("mean").alias("mean_window"))
    then = moments(reference, True).withColumnRenamed("mean", "mean_reference")
    shift = F.abs(
        F.try_divide(
            F.col("mean_window") - F.col("mean_reference"), F.nullif(F.col("sd"), F.lit(0.0))
        )
    )
    return (
        now.join(then, "feature")
        .select("feature", shift.alias("shift"))
        .orderBy(F.desc_nulls_last("shift"), F.asc("feature"))
        .limit(top)
    )
