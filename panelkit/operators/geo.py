"""Geometry coverage, selection and bounds of nested geometry documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.staging import stage

# Margin as a share of the span, and its least size in degrees.
PAD_SHARE, PAD_FLOOR = 0.08, 0.05
# Members of a geometry document that lead to positions.
MEMBERS = ("features", "geometry", "geometries", "coordinates")


def key_coverage(requested: DataFrame, available: DataFrame) -> DataFrame:
    """One row: requested keys (repeats count), matched, distinct unmatched, rate."""
    have = available.select("zip").distinct().withColumn("_hit", F.lit(True))
    # One row per key before the join, so a repeated key is not a skewed one.
    wanted = requested.groupBy("zip").agg(F.count(F.lit(1)).alias("n"))
    totals = wanted.join(have, "zip", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("requested"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("n"))), F.lit(0)).alias("matched"),
        F.count_if(F.col("_hit").isNull()).alias("unmatched"),
    )
    return totals.withColumn(
        "match_rate", F.coalesce(F.try_divide("matched", "requested"), F.lit(0.0))
    )


def unmatched_keys(requested: DataFrame, available: DataFrame) -> DataFrame:
    """Requested keys without a partner, distinct and sorted."""
    missing = requested.select("zip").join(available.select("zip"), "zip", "left_anti")
    return missing.distinct().orderBy("zip")


def subset_geometries(geometries: DataFrame, drawn: DataFrame) -> DataFrame:
    """Geometries of the drawn keys only."""
    return geometries.join(drawn.select(F.col("zip").alias("id")), "id", "left_semi")


def _documents(geometries: DataFrame) -> DataFrame:
    """Geometries as VARIANT, from JSON text, VARIANT or typed columns."""
    kind = geometries.schema["geometry"].dataType
    if isinstance(kind, T.VariantType):
        return geometries.select(F.col("geometry").alias("value"))
    text = F.col("geometry") if isinstance(kind, T.StringType) else F.to_json("geometry")
    return geometries.select(F.try_parse_json(text).alias("value"))


def points(geometries: DataFrame) -> DataFrame:
    """(lon, lat) of every position, whatever the kind and depth of a geometry.

    Documents are opened level by level until only positions are left: arrays that begin
    with two numbers. Collections hold geometries and geometries hold coordinates; other
    members, such as a bounding box, are not followed.
    """
    place = lambda i: F.try_variant_get(F.col("value"), f"$[{i}]", "double")
    nodes, found = _documents(geometries), []
    while True:
        read = nodes.select("value", place(0).alias("lon"), place(1).alias("lat"))
        at_leaf = F.col("lon").isNotNull() & F.col("lat").isNotNull()
        found.append(read.filter(at_leaf).select("lon", "lat"))
        inner = read.filter(~at_leaf).select("value")
        opened = inner.lateralJoin(inner.sparkSession.tvf.variant_explode(F.col("value").outer()).toDF("pos", "key", "child"))
        followed = opened.filter(F.col("key").isNull() | F.col("key").isin(*MEMBERS)).select(F.col("child").alias("value"))
        nodes = stage(followed, "members")
        if nodes.isEmpty():
            break
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def bounds(geometries: DataFrame) -> DataFrame:
    """One row with the bounding box of all points; all NULL when there are none."""
    return points(geometries).agg(
        F.min("lon").alias("lon_min"),
        F.min("lat").alias("lat_min"),
        F.max("lon").alias("lon_max"),
        F.max("lat").alias("lat_max"),
    )


def padded_ranges(box: DataFrame) -> DataFrame:
    """Box plus axis ranges with a margin that never falls below the floor."""
    made = {}
    for axis in ("lon", "lat"):
        low, high = F.col(f"{axis}_min"), F.col(f"{axis}_max")
        pad = F.greatest((high - low) * PAD_SHARE, F.lit(PAD_FLOOR))
        made[f"{axis}_from"], made[f"{axis}_to"] = low - pad, high + pad
    return box.withColumns(made)
