"""Registered queries that fit models, all with the full settings.

Forecasts have no SQL form, so next to a query with the figures stands one, named ``..._rows``,
with what SQL can state about the same written table: which rows are scored or averaged,
in which groups, and invariants of every value. Two stumps and a ridge of two features are
small enough for SQL as a whole. Fits are written once per state of the input files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import Controls
from panelkit.operators import attribution, boosting, decide, explain, metrics, models, ridge, split
from panelkit.operators.features import feature_columns
from panelkit.operators.trees import TreeSettings
from panelkit.plans import training
from panelkit.plans.build import bound_features, bound_lookup, written_once
from panelkit.plans.queries import MODEL, PARAMS, query, unflagged
from panelkit.sources import bind
from panelkit.sources.readers import source_manifest

PREDICTORS = models.standard_predictors(MODEL)
SETTINGS = ("maxDepth", "maxIter", "stepSize")


def stated(report: DataFrame, *labels: str) -> DataFrame:
    """Rows behind each metric, and whether the errors are finite and consistent."""
    sound = (F.col("rmse") >= F.col("mae") - 1e-9) & (F.col("mae") >= 0) & (F.col("rmse") < float("inf"))
    return report.select(*labels, "n", F.coalesce(sound, F.lit(False)).alias("sound"))


# --- cross-validation and holdout -----------------------------------------------


def _cv(spark, folder, name: str) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        return models.cross_validate(table, feature_columns(table), {name: PREDICTORS[name]}, PARAMS, MODEL)

    return written_once(spark, folder, f"cv_{name}", build)


@query
def ridge_cv(spark, folder):
    return _cv(spark, folder, "linear")


@query
def ridge_cv_rows(spark, folder):
    return stated(_cv(spark, folder, "linear"), "model", "month")


@query
def forest_cv(spark, folder):
    return _cv(spark, folder, "random_forest")


@query
def forest_cv_rows(spark, folder):
    return stated(_cv(spark, folder, "random_forest"), "model", "month")


@query
def gbt_cv(spark, folder):
    return _cv(spark, folder, "boosted")


@query
def gbt_cv_rows(spark, folder):
    return stated(_cv(spark, folder, "boosted"), "model", "month")


def _compared(spark, folder) -> DataFrame:
    """All models, fitted side by side: none of them fills the cluster. The long fits start first."""
    bound_features(spark, folder)
    jobs = [lambda name=name: _cv(spark, folder, name) for name in PREDICTORS]
    made = models.run_parallel(jobs[::-1], len(jobs))[::-1]
    whole = made[0]
    for part in made[1:]:
        whole = whole.unionByName(part)
    return whole.filter(F.col("month").isNull()).drop("month")


@query
def model_comparison(spark, folder):
    """Pooled figures of every model and the best by rank correlation."""
    return metrics.mark_best(_compared(spark, folder), MODEL.selection_metric)


@query
def model_comparison_rows(spark, folder):
    return stated(_compared(spark, folder), "model")


def _holdout(spark, folder) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        return models.holdout(table, feature_columns(table), PREDICTORS, MODEL)

    return written_once(spark, folder, "holdout", build)


@query
def holdout_models(spark, folder):
    return _holdout(spark, folder)


@query
def holdout_models_rows(spark, folder):
    return stated(_holdout(spark, folder), "model", "month")


def _grid(spark, folder) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        return models.grid_search(table, feature_columns(table), PARAMS, MODEL)

    return written_once(spark, folder, "grid", build)


@query
def grid_select(spark, folder):
    """Pooled figures of the whole grid; the first of the best settings is selected."""
    grid = _grid(spark, folder)
    best = models.select_best(grid, MODEL.selection_metric).select(F.col("grid_pos").alias("best"))
    named = [F.col("settings")[s].alias(s) for s in SETTINGS]
    return grid.select(
        "grid_pos", *named, "rmse", "mae", "dir_acc", "rank_corr", "n",
        (F.col("grid_pos") == best.scalar()).alias("selected"),
    )


@query
def grid_select_rows(spark, folder):
    named = [F.col("settings")[s].alias(s) for s in SETTINGS]
    return stated(_grid(spark, folder).select("grid_pos", *named, "n", "rmse", "mae"), "grid_pos", *SETTINGS)


# --- the fitted scorer ----------------------------------------------------------


def _settings(spark, folder) -> dict:
    best = models.select_best(_grid(spark, folder), MODEL.selection_metric).first()
    return training.typed_settings(best["settings"])


def _scorer(spark, folder):
    """(point, bands) with the selected settings on the whole train split."""

    def build(session, path):
        table = bound_features(session, path)
        rows = unflagged(table.filter(F.col("split") == "train"))
        return models.fit_scorer(rows, feature_columns(table), _settings(session, path), MODEL)

    nodes = written_once(spark, folder, "scorer", build)
    return models.scorer_of(nodes, feature_columns(bound_features(spark, folder)), MODEL)


def _scored_latest(spark, folder) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        latest = decide.latest_snapshot(table).select("zip", "month", *feature_columns(table))
        return models.score(latest, *_scorer(session, path))

    return written_once(spark, folder, "scored_latest", build)


BAND_COLUMNS = ("p05", "p10", "p50", "p90", "p95", "ci80_width", "ci90_width")


@query
def selected_model(spark, folder):
    """The refitted point model: its settings, trees and the rows it was fitted on."""
    table = bound_features(spark, folder)
    point, _ = _scorer(spark, folder)
    rows = unflagged(split.labelled(table.filter(F.col("split") == "train")))
    settings = [F.lit(float(v)).alias(k) for k, v in sorted(_settings(spark, folder).items())]
    return rows.agg(F.count(F.lit(1)).alias("trained_rows")).select(
        "trained_rows", *settings, F.lit(len(point.trees)).alias("trees"), F.lit(point.base).alias("base"),
        F.lit(sum(len(t["feature"]) for t in point.trees)).alias("nodes"),
    )


@query
def selected_model_rows(spark, folder):
    """Every tree's root covers all training rows, and the base is their mean target."""
    point, _ = _scorer(spark, folder)
    covers = sorted({float(t["cover"][0]) for t in point.trees})
    rows = [(len(point.columns), covers[0], covers[-1], round(point.base, 4))]
    return spark.createDataFrame(rows, "features int, least_cover double, most_cover double, base double")


@query
def score_latest(spark, folder):
    """Point forecast, quantiles and widths of every row of the latest month."""
    return _scored_latest(spark, folder).select("zip", "month", "point", *BAND_COLUMNS)


def _in_order(*columns: str) -> F.Column:
    ordered = F.lit(True)
    for low, high in zip(columns, columns[1:]):
        ordered = ordered & (F.col(low) <= F.col(high))
    return F.coalesce(ordered, F.lit(False))


@query
def score_latest_rows(spark, folder):
    """Every row of the latest month with ordered quantiles and widths that follow from them."""
    width = F.abs(F.col("p90") - F.col("p10") - F.col("ci80_width")) + F.abs(
        F.col("p95") - F.col("p05") - F.col("ci90_width")
    )
    return _scored_latest(spark, folder).select(
        "zip",
        "month",
        _in_order("p05", "p10", "p50", "p90", "p95").alias("ordered"),
        (width < 1e-9).alias("widths_agree"),
        F.col("point").isNotNull().alias("pointed"),
    )


@query
def ranked_export(spark, folder):
    """The latest month by risk-adjusted score."""
    ranked = decide.rank(_scored_latest(spark, folder), MODEL.risk_lambda)
    return ranked.select("rank", "zip", "month", "score", "point", *BAND_COLUMNS)


@query
def ranked_export_rows(spark, folder):
    """Ranks are 1 to n, each once, and the first rank has the highest score."""
    ranked = decide.rank(_scored_latest(spark, folder), MODEL.risk_lambda)
    return ranked.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("rank").alias("ranks"),
        F.min("rank").cast("long").alias("first"),
        F.max("rank").cast("long").alias("last"),
        (F.max_by("score", -F.col("rank")) == F.max("score")).alias("best_first"),
        (F.max_by("score", "rank") == F.min("score")).alias("worst_last"),
    )


def _decided(spark, folder) -> decide.Decision:
    """The whole decision on the fitted scorer, under a rate shock."""
    table = bound_features(spark, folder)
    point, bands = _scorer(spark, folder)
    controls = Controls(rate_bps=50, risk_tolerance="Low", min_roi=-1.0, max_downside=1.0, budget=2_000_000.0)
    latest = decide.latest_snapshot(table.filter(F.col("MORTGAGE30US").isNotNull()))
    return decide.decide(controls, latest, bound_lookup(spark, folder), lambda df: models.score(df, point, bands), MODEL)


@query
def decide_fitted(spark, folder):
    """Ranked rows of the decision with their share of the budget."""
    made = _decided(spark, folder)
    return decide.map_frame(made.ranked, made.qualifying)


@query
def decide_fitted_rows(spark, folder):
    """Rows evaluated, and a budget that is spent exactly if anything qualifies."""
    return _decided(spark, folder).summary.select(
        "evaluated", "budget", (F.abs(F.col("deployed") + F.col("unallocated") - F.col("budget")) < 1e-3).alias("adds_up")
    )


# --- bands, backtest, monitoring ------------------------------------------------


def _fold_bands(spark, folder) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        return models.fold_bands(table, feature_columns(table), PARAMS, MODEL, _settings(session, path))

    return written_once(spark, folder, "fold_bands", build)


@query
def quantile_bands(spark, folder):
    """Coverage of the bands on each gapped fold, and how many distinct medians there are."""
    rows = _fold_bands(spark, folder)
    distinct = rows.groupBy("fold").agg(F.countDistinct("p50").alias("distinct_p50"))
    return metrics.interval_coverage(rows).join(distinct, "fold")


@query
def quantile_bands_rows(spark, folder):
    """Rows of each gapped fold, no crossing, and whether the wider band covers at least as many."""
    rows = _fold_bands(spark, folder)
    crossed = rows.groupBy("fold").agg(F.count_if(~_in_order("p05", "p10", "p50", "p90", "p95")).alias("crossed"))
    return metrics.interval_coverage(rows).join(crossed, "fold").select(
        "fold", "n", "crossed", _in_order("coverage_80", "coverage_90").alias("nested"), F.col("coverage_90").between(0.5, 1.0).alias("covers")
    )


@query
def band_calibration(spark, folder):
    """Nominal and empirical coverage of the fitted bands, pooled over the folds."""
    return metrics.calibration_table(metrics.interval_coverage(_fold_bands(spark, folder)))


def _backtest(spark, folder) -> DataFrame:
    test = split.labelled(bound_features(spark, folder).filter(F.col("split") == "test"))
    return models.score(test, *_scorer(spark, folder))


@query
def backtest_all(spark, folder):
    """Forecast, band and realised change of every zip in the holdout months."""
    return _backtest(spark, folder).select(
        "zip", "month", F.col("point").alias("predicted"), "p10", "p50", "p90", F.col("target").alias("realized")
    )


@query
def backtest_all_rows(spark, folder):
    return _backtest(spark, folder).select(
        "zip", "month", F.col("target").alias("realized"), _in_order("p10", "p50", "p90").alias("inside")
    )


def _monitored(spark, folder) -> DataFrame:
    def build(session, path):
        table = bound_features(session, path)
        window = unflagged(split.rolling_window(table, PARAMS.train_window_months))
        return training.monitor_latest(window, feature_columns(table), _settings(session, path), PARAMS, MODEL)

    return written_once(spark, folder, "monitored", build)


@query
def monitor_latest(spark, folder):
    return _monitored(spark, folder)


@query
def monitor_latest_rows(spark, folder):
    return stated(_monitored(spark, folder), "month")


# --- attributions ---------------------------------------------------------------


def _ridge_parts(spark, folder) -> DataFrame:
    table = bound_features(spark, folder)
    rows = unflagged(table.filter(F.col("split") == "train"))
    fitted = ridge.fit_ridge(rows, feature_columns(table), MODEL.ridge_alpha)
    return attribution.ridge_contributions(fitted, decide.latest_snapshot(table))


def _tree_parts(spark, folder) -> DataFrame:
    def build(session, path):
        point, _ = _scorer(session, path)
        return attribution.tree_contributions(point, decide.latest_snapshot(bound_features(session, path)))

    return written_once(spark, folder, "latest_parts", build)


def _adds_up(parts: DataFrame) -> DataFrame:
    return attribution.additivity_error(parts).select("rows", (F.col("max_error") < 1e-6).alias("adds_up"))


@query
def ridge_contributions(spark, folder):
    return _ridge_parts(spark, folder)


@query
def ridge_additivity(spark, folder):
    return _adds_up(_ridge_parts(spark, folder))


@query
def tree_contributions(spark, folder):
    """Shapley values of every feature for every row of the latest month."""
    return _tree_parts(spark, folder)


@query
def tree_additivity(spark, folder):
    return _adds_up(_tree_parts(spark, folder))


def _importance(spark, folder) -> DataFrame:
    def build(session, path):
        point, _ = _scorer(session, path)
        rows = unflagged(bound_features(session, path).filter(F.col("split") == "train"))
        return explain.mean_importance(attribution.tree_contributions(point, rows))

    return written_once(spark, folder, "importance", build)


@query
def global_importance(spark, folder):
    """Mean absolute Shapley value per feature over all unflagged train rows, the largest first."""
    return _importance(spark, folder).orderBy(F.desc("importance"), "feature").limit(MODEL.top_k)


@query
def global_importance_rows(spark, folder):
    return _importance(spark, folder).agg(
        F.count(F.lit(1)).alias("features"),
        (F.min("importance") >= 0).alias("non_negative"),
        (F.max("importance") > 0).alias("informative"),
    )


# --- models that SQL can state --------------------------------------------------


def _fold_samples(spark, folder):
    table = bound_features(spark, folder)
    folds = split.rolling_folds(table, PARAMS, MODEL.folds)
    rows = unflagged(table.filter(F.col("split") == "train"))
    return rows, folds, split.assign_folds(rows, folds)


@query
def ridge_two_features(spark, folder):
    """Ridge of every fold on two features, from one matrix a month."""
    columns = ["price_mom_3m", "month_of_year"]
    rows, folds, _ = _fold_samples(spark, folder)
    complete = rows.dropna(subset=columns)
    fitted = ridge.fit_folds(complete, split.assign_folds(complete, folds), columns, folds, MODEL.ridge_alpha)
    made = [(i, m.intercept, *m.coefficients) for i, m in fitted.items()]
    return spark.createDataFrame(made, "fold int, intercept double, price_mom_3m double, month_of_year double")


def _stump(spark, folder, settings: TreeSettings) -> DataFrame:
    """Cut, rows and values of a one-split tree per fold, to four places."""
    _, _, assigned = _fold_samples(spark, folder)
    nodes = boosting.fit_nodes(models.fold_samples(assigned), ["month_of_year"], [settings], MODEL.seed)
    at = lambda number, node, name: F.max(F.when((F.col("tree") == number) & (F.col("node") == node), F.col(name)))
    return nodes.groupBy(F.col("sample").alias("fold")).agg(
        F.round(at(-1, 0, "value"), 4).alias("base"),
        at(0, 0, "cut").alias("cut"),
        at(0, 1, "cover").cast("long").alias("left_rows"),
        at(0, 2, "cover").cast("long").alias("right_rows"),
        F.round(at(0, 1, "value"), 4).alias("left_value"),
        F.round(at(0, 2, "value"), 4).alias("right_value"),
    )


@query
def stump_squared(spark, folder):
    return _stump(spark, folder, TreeSettings(rounds=1, depth=1, step=1.0, l2=1.0))


@query
def stump_pinball(spark, folder):
    return _stump(spark, folder, TreeSettings(rounds=1, depth=1, step=1.0, l2=1.0, quantile=0.9))


# --- sources --------------------------------------------------------------------


@query
def source_files(spark, folder):
    """Files of a source: bytes, rows and a hash of the content."""
    made = source_manifest(bind.table(spark, folder, "lineitem"))
    return made.select("file_name", "file_size", "rows", "content_hash")


@query
def source_files_rows(spark, folder):
    made = source_manifest(bind.table(spark, folder, "lineitem"))
    return made.agg(
        F.sum("rows").alias("rows"),
        (F.count(F.lit(1)) > 0).alias("has_files"),
        F.count_if(F.col("content_hash").isNull()).alias("unhashed"),
    )
