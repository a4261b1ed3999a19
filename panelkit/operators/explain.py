"""Attributions as rows (zip, month, feature, contribution) and views of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.text import feature_label, phrase
from panelkit.operators.quantiles import grouped_percentiles

KEY = ["zip", "month"]
OTHER = "All other features"


def unpivot_features(df: DataFrame, columns: Sequence[str], value: str = "value") -> DataFrame:
    """Feature matrix to one row per (key, feature)."""
    typed = df.select(*KEY, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(KEY, list(columns), "feature", value)


def linear_contributions(
    features: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float]
) -> DataFrame:
    """coefficient x (value - mean) per feature; a missing value contributes 0.

    With the base value at the means these add up to the linear prediction.
    The coefficients and means are model parameters, one per feature.
    """
    made = {
        c: F.coalesce(F.lit(float(b)) * (F.col(c) - F.lit(float(means[c]))), F.lit(0.0))
        for c, b in coefficients.items()
    }
    wide = features.select(*KEY, *[v.alias(c) for c, v in made.items()])
    return wide.unpivot(KEY, list(made), "feature", "contribution")


def top_contributions(contributions: DataFrame, k: int) -> DataFrame:
    """The k largest by absolute value per key, sign kept.

    A window partition is one row of the feature table: as many rows as there
    are features.
    """
    order = Window.partitionBy(*KEY).orderBy(F.desc(F.abs("contribution")), F.asc("feature"))
    return contributions.withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= k
    )


def with_residual(contributions: DataFrame, k: int) -> DataFrame:
    """Top k plus one row of everything else, so the parts still add up."""
    order = Window.partitionBy(*KEY).orderBy(F.desc(F.abs("contribution")), F.asc("feature"))
    place = F.least(F.row_number().over(order), F.lit(k + 1))
    placed = contributions.withColumn("place", place)
    label = F.when(F.col("place") <= k, F.col("feature")).otherwise(F.lit(OTHER))
    return placed.groupBy(*KEY, "place", label.alias("feature")).agg(
        F.sum("contribution").alias("contribution")
    )


def driver_sentences(contributions: DataFrame, k: int = 3) -> DataFrame:
    """One sentence per key naming the top drivers and their direction."""
    top = top_contributions(contributions, k).withColumn("label", feature_label("feature"))
    entry = F.struct("place", "contribution", "label")
    gathered = top.groupBy(*KEY).agg(F.array_sort(F.collect_list(entry)).alias("top"))

    def names(positive: bool) -> F.Column:
        keep = F.filter(
            "top", lambda e: e["contribution"] > 0 if positive else e["contribution"] < 0
        )
        return phrase(F.transform(keep, lambda e: e["label"]))

    up, down = names(True), names(False)
    up_part = F.concat(F.lit("**"), up, F.lit("** push this forecast up"))
    down_part = F.concat(F.lit("**"), down, F.lit("** pull it down"))
    # The wording of the sentence.
    sentence = (
        F.when(
            up.isNotNull() & down.isNotNull(), F.concat(up_part, F.lit(" , while "), down_part, F.lit("."))
        )
        .when(up.isNotNull(), F.concat(up_part, F.lit(".")))
        .when(down.isNotNull(), F.concat(down_part, F.lit(".")))
        .otherwise(F.lit("The top features contribute almost nothing to this forecast."))
    )
    return gathered.select(*KEY, sentence.alias("sentence"))


def mean_importance(contributions: DataFrame, k: int | None = None) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    mean = contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
    ordered = mean.orderBy(F.desc("importance"), F.asc("feature"))
    return ordered.limit(k) if k else ordered


def seeded_sample(df: DataFrame, n: int, seed: int, keys: Sequence[str] = KEY) -> DataFrame:
    """n rows without replacement, the same ones however the data is partitioned.

    Rows are ordered by a seeded hash of their key; Spark keeps n per task.
    """
    token = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    ordered = df.withColumn("_h", token).orderBy("_h", *keys)
    return ordered.limit(n).drop("_h")


def peer_medians(
    snapshot: DataFrame,
    lookup: DataFrame,
    columns: Sequence[str],
    max_group: int | None = None,
) -> DataFrame:
    """Each zip's feature values beside the median of its metro, for all zips.

    A zip without a metro is compared with the whole universe.
    """
    # (universe, feature) groups hold every zip: the percentile operator splits them.
    rows = unpivot_features(snapshot, columns).drop("month")
    placed = rows.join(lookup.select("zip", "metro"), "zip", "left")
    per_metro = grouped_percentiles(
        placed.filter(F.col("metro").isNotNull()),
        ["metro", "feature"],
        {"metro_median": ("value", 0.5)},
        max_group=max_group,
    )
    overall = grouped_percentiles(
        rows, ["feature"], {"all_median": ("value", 0.5)}, max_group=max_group
    )
    # Zips without a metro share one key that matches nothing: they skip the join.
    known = placed.filter(F.col("metro").isNotNull()).join(per_metro, ["metro", "feature"], "left")
    unknown = placed.filter(F.col("metro").isNull()).withColumn("metro_median", F.lit(None).cast("double"))
    return (
        known.unionByName(unknown)
        .join(overall, "feature", "left")
        .select(
            "zip",
            "metro",
            feature_label("feature").alias("feature"),
            F.col("value").alias("this_zip"),
            F.when(F.col("metro").isNull(), F.col("all_median"))
            .otherwise(F.col("metro_median"))
            .alias("metro_median"),
        )
    )
