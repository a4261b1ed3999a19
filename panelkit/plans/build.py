"""From landed tables to the feature table, with one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.config import TRACKER_METRICS, PanelParams
from panelkit.operators.contracts import require_macro_complete, require_rows
from panelkit.operators.features import build_features, document
from panelkit.operators.panel import build_panel
from panelkit.operators.split import assign_split
from panelkit.operators.tidy import (
    drop_empty_columns,
    resolve_metro,
    select_rows,
    tidy_macro,
    tidy_tracker,
)
from panelkit.sources import bind
from panelkit.staging import exists, file_system, stage, staged_path


# Splits, folds and snapshots select months: sorted files let them skip row groups.
STORED_ORDER = ("month", "zip")


def conform(
    tracker: DataFrame,
    index: DataFrame,
    observations: DataFrame,
    params: PanelParams = PanelParams(),
    validate: bool = True,
) -> DataFrame:
    """Raw tracker, tidy index and raw macro observations to the joined panel.

    The tidy tracker is written before the checks read it.
    """
    tidy = stage(tidy_tracker(select_rows(tracker, params), params), "tidy")
    if validate:
        require_rows(tidy, "tidy tracker")
    tidy = drop_empty_columns(tidy, TRACKER_METRICS)
    macro = tidy_macro(observations, params.macro_series)
    panel = build_panel(tidy, index, macro, params, validate)
    if validate:
        require_macro_complete(panel, macro, params.macro_series)
    return panel


def feature_table(panel: DataFrame, params: PanelParams = PanelParams()) -> DataFrame:
    """Documented features with their split, materialised."""
    made = build_features(panel, params).sortWithinPartitions(*STORED_ORDER)
    features = stage(made, "features")
    return document(assign_split(features, params), params)


# --- the same on the test tables ------------------------------------------------


def tidy_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Tidy tracker of the test tables, lazy."""
    raw = bind.tracker(spark, folder, bind.PARAMS.property_type)
    return tidy_tracker(select_rows(raw, bind.PARAMS), bind.PARAMS)


def macro_months(spark: SparkSession, folder: str, fill: bool = True) -> DataFrame:
    return tidy_macro(bind.macro_observations(spark, folder), bind.PARAMS.macro_series, fill)


def bound_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Joined panel of the test tables; the tidy steps guarantee its keys.

    ``price_drops`` is never published there, so it is not carried along.
    """
    tidy = tidy_cells(spark, folder).drop("price_drops")
    index = bind.index(spark, folder)
    return build_panel(tidy, index, macro_months(spark, folder), bind.PARAMS, validate=False)


# Written tables of this process: (application, table, input files) -> path.
_WRITTEN: dict[tuple, str] = {}


def _inputs(spark: SparkSession, folder: str) -> tuple:
    """Name, time, bytes and file count of each input table, from the file system."""
    system, path = file_system(spark, folder)
    tables = []
    for entry in system.listStatus(path):
        size = system.getContentSummary(entry.getPath())
        tables.append(
            (
                entry.getPath().toString(),
                entry.getModificationTime(),
                size.getLength(),
                size.getFileCount(),
            )
        )
    return tuple(sorted(tables))


def written_once(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    """Table that the build job writes and every later job reads.

    The models and decisions read the feature table, they do not rebuild it. It
    is written again whenever an input file changes.
    """
    key = (spark.sparkContext.applicationId, name, _inputs(spark, folder))
    if key not in _WRITTEN or not exists(spark, _WRITTEN[key]):
        _WRITTEN[key] = staged_path(build(spark, folder), name)
    return spark.read.parquet(_WRITTEN[key])


def build_bound_features(spark: SparkSession, folder: str) -> DataFrame:
    made = build_features(bound_panel(spark, folder), bind.PARAMS)
    features = stage(made.sortWithinPartitions(*STORED_ORDER), "features")
    return document(assign_split(features, bind.PARAMS), bind.PARAMS)


def build_bound_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return resolve_metro(bind.metro_rows(spark, folder))


def bound_features(spark: SparkSession, folder: str) -> DataFrame:
    """Feature table of the test tables with its split."""
    return written_once(spark, folder, "feature_table", build_bound_features)


def bound_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Zip to metro lookup of the test tables."""
    return written_once(spark, folder, "lookup", build_bound_lookup)
