"""Train, select, refit, monitor and retrain: driver loops over Spark jobs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from panelkit.config import ModelParams, PanelParams
from panelkit.errors import ContractError
from panelkit.operators import metrics, models
from panelkit.operators.features import feature_columns
from panelkit.operators.monitor import degradation_gate
from panelkit.operators.split import drop_flagged, rolling_window, recent_months, shift_month
from panelkit.plans.build import feature_table
from panelkit.plans.refresh import Refreshed, current_panel, refresh
from panelkit.sinks.runs import log_run, selected_settings
from panelkit.sinks.tables import record_version
from panelkit.staging import stage

INTEGER_SETTINGS = {"maxDepth", "maxIter", "maxLeaves", "numTrees", "minInstancesPerNode"}


def typed_settings(settings: Mapping[str, float]) -> dict:
    return {k: int(v) if k in INTEGER_SETTINGS else float(v) for k, v in settings.items()}


class Trained(NamedTuple):
    settings: dict
    point: models.TreeModel
    bands: models.BandModel
    report: DataFrame


def train(
    features: DataFrame,
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
) -> Trained:
    """Grid over the gapped folds, best by the selection metric, refit on train."""
    columns = feature_columns(features)
    report = stage(models.grid_search(features, columns, panel_params, params), "grid")
    best = models.select_best(report, params.selection_metric).first()
    settings = typed_settings(best["settings"])
    rows = drop_flagged(features.filter("split = 'train'"), params.exclude_flags)
    point, bands = models.scorer_of(models.fit_scorer(rows, columns, settings, params), columns, params)
    return Trained(settings, point, bands, report)


def train_and_save(
    features: DataFrame,
    root: str,
    version: str,
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
) -> Trained:
    """Train, write both models under a version, promote it and log the run."""
    made = train(features, panel_params, params)
    spark = features.sparkSession
    best = models.select_best(made.report, params.selection_metric).first()
    path = f"{root}/models/versions/{version}"
    made.point.save(f"{path}/point")
    made.bands.save(f"{path}/bands")
    record_version(spark, f"{root}/models", version, path, True)
    log_run(
        spark,
        f"{root}/runs",
        kind="train",
        version=version,
        settings={k: float(v) for k, v in made.settings.items()},
        baseline_rmse=best["rmse"],
        promoted=True,
    )
    return made


def monitor_latest(
    window: DataFrame,
    columns,
    settings: Mapping,
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
) -> DataFrame:
    """Metrics of the most recent labelled month, fitted with the gap before it."""
    months = recent_months(window, 1)
    if not months:
        raise ContractError("no labelled month to monitor")
    end = shift_month(months[0], -panel_params.cv_gap_months)
    before = window.filter(F.col("month") <= F.lit(end))
    latest = window.filter(F.col("month") == F.lit(months[0]))
    if before.isEmpty() or latest.isEmpty():
        raise ContractError("the window is too short for the gap before the monitored month")
    fitted = models.fit_model(before, columns, "boosted", settings, params.seed)
    scored = fitted.transform(latest).select(*models.KEPT, "prediction")
    return metrics.group_metrics(stage(scored, "monitor"), ["month"]).select(
        "month", "rmse", "mae", "dir_acc", "rank_corr", "n"
    )


class Retrained(NamedTuple):
    decision: Row
    drift: DataFrame
    version: str


def retrain(
    features: DataFrame,
    root: str,
    version: str,
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
    accept_degraded: bool = False,
    drift_keeps_flagged: bool = True,
) -> Retrained:
    """One cycle: window, monitor, gate, fit, drift, version, log.

    A degraded model is saved but not promoted unless it is accepted. The drift
    reference keeps flagged rows by default.
    """
    spark = features.sparkSession
    columns = feature_columns(features)
    settings, baseline = selected_settings(spark, f"{root}/runs")
    settings = typed_settings(settings)
    recent = rolling_window(features, panel_params.train_window_months)
    window = stage(drop_flagged(recent, params.exclude_flags), "window")

    # one thread for each fit: neither reads what the other makes
    fresh, nodes = models.run_parallel(
        [
            lambda: monitor_latest(window, columns, settings, panel_params, params),
            lambda: models.fit_scorer(window, columns, settings, params),
        ],
        2,
    )
    gate = degradation_gate(
        fresh.select(F.col("rmse").alias("fresh_rmse"), F.lit(baseline).alias("baseline_rmse")),
        params.degradation_multiplier,
        accept_degraded,
    ).first()

    point, bands = models.scorer_of(nodes, columns, params)
    path = f"{root}/models/versions/{version}"
    point.save(f"{path}/point")
    bands.save(f"{path}/bands")
    record_version(spark, f"{root}/models", version, path, gate["promote"])

    reference = features.filter("split = 'train'")
    if not drift_keeps_flagged:
        reference = drop_flagged(reference, params.exclude_flags)
    drift = metrics.drift_stats(window, reference, columns)
    log_run(
        spark,
        f"{root}/runs",
        kind="retrain",
        version=version,
        settings={k: float(v) for k, v in settings.items()},
        baseline_rmse=baseline,
        fresh_rmse=gate["fresh_rmse"],
        degraded=gate["degraded"],
        promoted=gate["promote"],
        exit_code=gate["exit_code"],
        alert=gate["alert"],
    )
    return Retrained(gate, drift, version)


def retrain_from_files(
    spark: SparkSession,
    root: str,
    version: str,
    tracker: str,
    index: str,
    series: str,
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
    accept_degraded: bool = False,
) -> tuple[Refreshed, Retrained]:
    """The whole cycle: refresh the panel from the landed files, then retrain on it."""
    done = refresh(spark, f"{root}/store", tracker, index, series, panel_params)
    features = feature_table(current_panel(spark, f"{root}/store"), panel_params)
    return done, retrain(features, root, version, panel_params, params, accept_degraded)


def quick_params(params: ModelParams = ModelParams()) -> ModelParams:
    """The same jobs with small ensembles, for tests and trials."""
    return replace(
        params,
        grid={"maxDepth": (2, 3), "maxIter": (4, 8), "stepSize": (0.1, 0.3)},
        forest={"numTrees": 20, "maxDepth": 6, "minInstancesPerNode": 20, "subsamplingRate": 0.4},
        boosted={"maxIter": 8, "maxDepth": 3, "stepSize": 0.2},
        leafwise=dict(params.leafwise) | {"maxIter": 8, "maxLeaves": 9, "stepSize": 0.2},
        band_trees=20,
    )
