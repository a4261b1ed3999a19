"""From landed files to the panel and the zip-to-metro lookup, and back out to files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import PanelParams
from panelkit.operators.contracts import discover_wide
from panelkit.operators.tidy import metro_counts, resolve_metro, tidy_wide
from panelkit.plans.build import conform
from panelkit.sources.readers import read_series, read_tracker, read_wide
from panelkit.staging import application_folder, file_system, stage


class Landed(NamedTuple):
    panel: DataFrame
    lookup: DataFrame


def from_files(
    spark: SparkSession,
    tracker: str,
    index: str,
    series: str | list[str],
    params: PanelParams = PanelParams(),
    synonyms: Mapping[str, Sequence[str]] = {},
    validate: bool = True,
) -> Landed:
    """The checked panel and the lookup of one landing of the three sources.

    The tracker is read as text once and written as a typed table; the panel and the
    lookup read that table.
    """
    rows = stage(read_tracker(spark, tracker, synonyms), "tracker")
    lookup = resolve_metro(metro_counts(rows))
    wide = read_wide(spark, index)
    key, _ = discover_wide(wide.columns)
    panel = conform(rows, tidy_wide(wide, key), read_series(spark, series), params, validate)
    return Landed(panel, lookup)


def land_series(observations: DataFrame, folder: str) -> str:
    """One nested JSON file per series, named after it; returns their glob.

    A series has at most one observation a day, so its file is small.
    """
    spark = observations.sparkSession
    names = [r.series for r in observations.select("series").distinct().orderBy("series").collect()]
    for name in names:
        one = observations.filter(F.col("series") == name)
        pair = F.struct(F.col("date").cast("string").alias("date"), "value")
        nested = one.agg(F.sort_array(F.collect_list(pair)).alias("observations"))
        made = f"{folder}/{name}"
        nested.coalesce(1).write.json(made)
        system, place = file_system(spark, made)
        part = next(s.getPath() for s in system.listStatus(place) if s.getPath().getName().startswith("part-"))
        system.rename(part, file_system(spark, f"{folder}/{name}.json")[1])
    return f"{folder}/*.json"


def landing_folder(spark: SparkSession) -> str:
    """A new folder on shared storage."""
    return f"{application_folder(spark)}/landed-{uuid.uuid4().hex[:12]}"


def land_tracker(rows: DataFrame, path: str) -> str:
    """Compressed tab-separated text with a header."""
    rows.write.csv(path, sep="\t", header=True, compression="gzip")
    return path


def land_tracker_by_year(rows: DataFrame, folder: str) -> str:
    """The tracker in one file a year of the window's end; returns their glob.

    Landing a year again replaces its file.
    """
    year = F.year("period_end").alias("ending")
    spread = rows.select("*", year).repartition("ending")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ending").csv(
        folder, sep="\t", header=True, compression="gzip"
    )
    return f"{folder}/ending=*/*.gz"


def land_wide(rows: DataFrame, path: str) -> str:
    rows.write.csv(path, header=True)
    return path
