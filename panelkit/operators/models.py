"""Forecast models: naive, ridge, forest, boosted trees, quantile bands.

A predictor is ``fn(train, held, columns) -> held + prediction``; any callable
of that form takes part in cross-validation and holdout. One that also has ``over_folds``
fits all folds at once. Medians and cut points come from the training rows only.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import ModelParams, PanelParams
from panelkit.errors import ContractError, PanelError
from panelkit.functions.numbers import quantile_label
from panelkit.operators import boosting, metrics, ridge
from panelkit.operators.boosting import KEPT, TreeModel
from panelkit.operators.ridge import RidgeModel
from panelkit.operators.split import Fold, assign_folds, drop_flagged, require_filled_folds, rolling_folds
from panelkit.operators.trees import TreeSettings
from panelkit.staging import stage

Predictor = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]


# --- single models --------------------------------------------------------------


def predict_zero(train: DataFrame, held: DataFrame, columns: Sequence[str]) -> DataFrame:
    return held.withColumn("prediction", F.lit(0.0))


def predict_momentum(train: DataFrame, held: DataFrame, columns: Sequence[str]) -> DataFrame:
    return held.withColumn("prediction", F.coalesce("price_mom_3m", F.lit(0.0)))


def tree_settings(kind: str, settings: Mapping[str, float]) -> TreeSettings:
    """Settings of a boosted or forest model by their public names."""
    least = float(settings.get("minInstancesPerNode", 1))
    depth = int(settings["maxDepth"])
    if kind == "forest":
        return TreeSettings(
            rounds=int(settings["numTrees"]), depth=depth, least=least, l2=0.0, averaged=True,
            share=float(settings["subsamplingRate"]), impute=True,
        )
    leaves = settings.get("maxLeaves")
    return TreeSettings(
        rounds=int(settings["maxIter"]), depth=depth, step=float(settings["stepSize"]), least=least,
        l2=float(settings.get("l2", 1.0)), leaves=int(leaves) if leaves else None,
    )


def fit_model(
    train: DataFrame, columns: Sequence[str], kind: str, settings: Mapping, seed: int
) -> RidgeModel | TreeModel:
    """Fit one of: ridge, forest, boosted."""
    if kind == "ridge":
        return ridge.fit_ridge(train, columns, settings["alpha"])
    if kind not in ("forest", "boosted"):
        raise PanelError(f"unknown model kind {kind!r}")
    return boosting.fit_trees(train, columns, [tree_settings(kind, settings)], seed)[0]


def load_model(spark: SparkSession, path: str) -> TreeModel:
    return TreeModel.load(spark, path)


@dataclass(frozen=True)
class ModelPredictor:
    """A kind of model with its settings."""

    kind: str
    settings: Mapping
    seed: int

    def __call__(self, train: DataFrame, held: DataFrame, columns: Sequence[str]) -> DataFrame:
        return fit_model(train, columns, self.kind, self.settings, self.seed).transform(held)

    def over_folds(self, rows: DataFrame, columns: Sequence[str], folds: Sequence[Fold]) -> DataFrame:
        """fold, zip, month, target, prediction of every held-out row.

        ``rows`` are unflagged rows of the train split. All folds are fitted at once.
        """
        assigned = assign_folds(rows, folds)
        if self.kind != "ridge":
            made = boosting.held_out_predictions(
                fold_samples(assigned), columns, [tree_settings(self.kind, self.settings)], seed=self.seed
            )
            return made.select(F.col("sample").alias("fold"), *KEPT, "prediction")
        fitted = ridge.fit_folds(rows, assigned, columns, folds, self.settings["alpha"])
        value = F.coalesce(*[F.when(F.col("fold") == i, m.value()) for i, m in fitted.items()])
        return assigned.where("role = 'val'").select("fold", *KEPT, value.alias("prediction"))


def fold_samples(assigned: DataFrame) -> DataFrame:
    """Rows with their folds as training samples."""
    return assigned.withColumns({"sample": F.col("fold"), "train": F.col("role") == "train"})


def predictor(kind: str, settings: Mapping, seed: int) -> ModelPredictor:
    return ModelPredictor(kind, settings, seed)


def standard_predictors(params: ModelParams = ModelParams()) -> dict[str, Predictor]:
    """The compared models, by name."""
    return {
        "naive_zero": predict_zero,
        "naive_momentum": predict_momentum,
        "linear": predictor("ridge", {"alpha": params.ridge_alpha}, params.seed),
        "random_forest": predictor("forest", params.forest, params.seed),
        "leafwise": predictor("boosted", params.leafwise, params.seed),
        "boosted": predictor("boosted", params.boosted, params.seed),
    }


# --- cross-validation and holdout -----------------------------------------------


def run_parallel(jobs: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Run independent fits from a few driver threads; each fit is a Spark job."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(parallelism) as pool:
        futures = [pool.submit(inherit(job)) for job in jobs]
        return [f.result() for f in futures]


def fold_pair(
    features: DataFrame, fold: Fold, flags: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) rows of one fold, flagged rows removed from both."""
    rows = drop_flagged(features.filter(F.col("split") == "train"), flags)
    month = F.col("month")
    train = rows.filter(month.between(F.lit(fold.train_start), F.lit(fold.train_end)))
    return train, rows.filter(month == F.lit(fold.val_month))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def cv_predictions(
    features: DataFrame,
    columns: Sequence[str],
    predictors: Mapping[str, Predictor],
    folds: Sequence[Fold],
    params: ModelParams = ModelParams(),
    parallelism: int = 4,
) -> DataFrame:
    """Held-out predictions of every model and fold: one written table."""
    pairs = [(f, *fold_pair(features, f, params.exclude_flags)) for f in folds]
    rows = drop_flagged(features.filter(F.col("split") == "train"), params.exclude_flags)

    def named(name: str, made: DataFrame) -> DataFrame:
        return made.select(F.lit(name).alias("model"), "fold", *KEPT, "prediction")

    def job(name: str, fn: Predictor, fold: Fold, train: DataFrame, held: DataFrame):
        return lambda: named(name, fn(train, held.withColumn("fold", F.lit(fold.fold)), columns))

    jobs = []
    for name, fn in predictors.items():
        if hasattr(fn, "over_folds"):
            jobs.append(lambda name=name, fn=fn: named(name, fn.over_folds(rows, columns, folds)))
        else:
            jobs += [job(name, fn, f, t, h) for f, t, h in pairs]
    return stage(_union(run_parallel(jobs, parallelism)), "cv_predictions")


def cross_validate(
    features: DataFrame,
    columns: Sequence[str],
    predictors: Mapping[str, Predictor],
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
    parallelism: int = 4,
) -> DataFrame:
    """Per-fold and (NULL month) pooled metrics of every predictor."""
    folds = rolling_folds(features, panel_params, params.folds)
    require_filled_folds(drop_flagged(features, params.exclude_flags), folds)
    rows = cv_predictions(features, columns, predictors, folds, params, parallelism)
    return metrics.metrics_report(rows, ["model"])


def holdout(
    features: DataFrame,
    columns: Sequence[str],
    predictors: Mapping[str, Predictor],
    params: ModelParams = ModelParams(),
    parallelism: int = 4,
) -> DataFrame:
    """Refit on the whole train split, score the test split once; metrics per month."""
    rows = drop_flagged(features, params.exclude_flags)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    if test.isEmpty():
        raise ContractError("the test split is empty after dropping flagged rows")

    def named(name: str, made: DataFrame) -> DataFrame:
        return made.select(F.lit(name).alias("model"), *KEPT, "prediction")

    # boosted models are one fit: they share cut points and binned rows
    boosted = {n: fn for n, fn in predictors.items() if isinstance(fn, ModelPredictor) and fn.kind == "boosted"}

    def together() -> list[DataFrame]:
        settings = [tree_settings(fn.kind, fn.settings) for fn in boosted.values()]
        fitted = boosting.fit_trees(train, columns, settings)  # draws nothing, so needs no seed
        return [named(n, model.transform(test)) for n, model in zip(boosted, fitted)]

    def job(name: str, fn: Predictor):
        return lambda: [named(name, fn(train, test, columns))]

    jobs = [together] if boosted else []
    jobs += [job(n, fn) for n, fn in predictors.items() if n not in boosted]
    parts = [part for made in run_parallel(jobs, parallelism) for part in made]
    return metrics.metrics_report(stage(_union(parts), "holdout"), ["model"])


def expand_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values, in the order of the lists."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def grid_table(spark: SparkSession, grid: Mapping[str, Sequence]) -> DataFrame:
    """The same combinations as rows with their grid position."""
    rows = [(i, {k: float(v) for k, v in c.items()}) for i, c in enumerate(expand_grid(grid))]
    return spark.createDataFrame(rows, "grid_pos int, settings map<string,double>")


def select_best(results: DataFrame, metric: str = "rank_corr") -> DataFrame:
    """Row with the highest metric; missing last, ties to the first grid position."""
    usable = F.when(~F.isnan(metric), F.col(metric))
    return results.orderBy(usable.desc_nulls_last(), F.asc("grid_pos")).limit(1)


def grid_search(
    features: DataFrame,
    columns: Sequence[str],
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
) -> DataFrame:
    """Pooled metrics of every boosted-tree setting over the gapped folds.

    All settings and folds are one fit; settings that only differ in their number of
    trees are read off the same ensemble.
    """
    folds = rolling_folds(features, panel_params, params.folds)
    rows = drop_flagged(features.filter(F.col("split") == "train"), params.exclude_flags)
    distinct: dict[tuple, list[tuple[int, int]]] = {}
    for i, setting in enumerate(expand_grid(params.grid)):
        rest = tuple(sorted((k, v) for k, v in setting.items() if k != "maxIter"))
        distinct.setdefault(rest, []).append((int(setting["maxIter"]), i))
    fits = [tree_settings("boosted", dict(rest) | {"maxIter": max(own)[0]}) for rest, own in distinct.items()]
    marks = [sorted({n for n, _ in own}) for own in distinct.values()]
    made = boosting.held_out_predictions(fold_samples(assign_folds(rows, folds)), columns, fits, marks, params.seed)
    places = [(k, n, i) for k, own in enumerate(distinct.values()) for n, i in own]
    spark = features.sparkSession
    placed = made.join(F.broadcast(spark.createDataFrame(places, "setting int, rounds int, grid_pos int")), ["setting", "rounds"])
    report = metrics.metrics_report(placed, ["grid_pos"]).filter(F.col("month").isNull())
    return report.drop("month").join(grid_table(spark, params.grid), "grid_pos")


# --- bands ----------------------------------------------------------------------


def monotone_quantiles(
    df: DataFrame, quantiles: str, levels: Sequence[float] = ModelParams.quantiles
) -> DataFrame:
    """Sort an array of quantiles per row, name its places, add the band widths."""
    labels = [quantile_label(q) for q in levels]
    ordered = df.withColumn("_sorted", F.array_sort(quantiles))
    # Rows whose array has another length than the levels are a defect, not a case.
    checked = F.when(F.size("_sorted") == len(labels), F.col("_sorted")).otherwise(
        F.raise_error(F.lit(f"expected {len(labels)} quantiles per row"))
    )
    ordered = ordered.withColumn("_sorted", checked)
    named = ordered.withColumns({n: F.col("_sorted")[i] for i, n in enumerate(labels)})
    widths = {
        name: F.col(hi) - F.col(lo)
        for name, lo, hi in (("ci80_width", "p10", "p90"), ("ci90_width", "p05", "p95"))
        if lo in labels and hi in labels
    }
    return named.withColumns(widths).drop("_sorted", quantiles)


@dataclass(frozen=True)
class BandModel:
    """One ensemble per quantile level."""

    models: tuple[TreeModel, ...]
    levels: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add p05..p95, sorted, and the band widths."""
        return monotone_quantiles(df.withColumn("_q", boosting.ensemble_values(self.models)), "_q", self.levels)

    def save(self, path: str) -> None:
        boosting.save_models(self.models, path)

    @staticmethod
    def load(
        spark: SparkSession, path: str, levels: tuple[float, ...] = ModelParams.quantiles
    ) -> "BandModel":
        return BandModel(tuple(boosting.load_models(spark, path)), tuple(levels))


def band_settings(params: ModelParams, point: Mapping[str, float] | None = None) -> list[TreeSettings]:
    """A pinball ensemble per level: depth and step of the point model, fewer trees."""
    chosen = dict(point or params.boosted)
    return [
        TreeSettings(
            rounds=params.band_trees, depth=int(chosen["maxDepth"]), step=float(chosen["stepSize"]),
            least=float(params.band_least), quantile=q,
        )
        for q in params.quantiles
    ]


def fit_scorer(
    train: DataFrame, columns: Sequence[str], point: Mapping[str, float], params: ModelParams = ModelParams()
) -> DataFrame:
    """Point model and bands as one fit: their trees as rows, for ``scorer_of``."""
    settings = [tree_settings("boosted", point), *band_settings(params, point)]
    return boosting.fit_nodes(boosting.whole_sample(train), columns, settings, params.seed)


def scorer_of(nodes: DataFrame, columns: Sequence[str], params: ModelParams = ModelParams()) -> tuple[TreeModel, BandModel]:
    point, *bands = TreeModel.read(nodes, columns, 1 + len(params.quantiles))
    return point, BandModel(tuple(bands), tuple(params.quantiles))


def fit_bands(
    train: DataFrame,
    columns: Sequence[str],
    params: ModelParams = ModelParams(),
    point: Mapping[str, float] | None = None,
    max_group: int | None = None,
) -> BandModel:
    """Boosting on the pinball loss, all levels in one fit.

    Trees are grown on its gradients; a leaf moves its rows by the percentile of
    their residuals.
    """
    made = boosting.fit_trees(train, columns, band_settings(params, point), params.seed, max_group)
    return BandModel(tuple(made), tuple(params.quantiles))


def score(features: DataFrame, point: RidgeModel | TreeModel, bands: BandModel) -> DataFrame:
    """Point forecast, sorted quantiles and widths; all input columns kept."""
    return bands.transform(point.transform(features, "point"))


def calibrate(
    features: DataFrame,
    columns: Sequence[str],
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
    point: Mapping[str, float] | None = None,
) -> DataFrame:
    """Coverage of freshly fitted bands on every gapped fold."""
    return metrics.interval_coverage(fold_bands(features, columns, panel_params, params, point))


def fold_bands(
    features: DataFrame,
    columns: Sequence[str],
    panel_params: PanelParams = PanelParams(),
    params: ModelParams = ModelParams(),
    point: Mapping[str, float] | None = None,
) -> DataFrame:
    """Held-out rows of every fold with their bands; all folds and levels are one fit."""
    folds = rolling_folds(features, panel_params, params.folds)
    rows = drop_flagged(features.filter(F.col("split") == "train"), params.exclude_flags)
    settings = band_settings(params, point)
    made = boosting.held_out_predictions(fold_samples(assign_folds(rows, folds)), columns, settings, seed=params.seed)
    levels = made.groupBy(F.col("sample").alias("fold"), *KEPT).pivot("setting", list(range(len(settings)))).agg(F.first("prediction"))
    quantiles = F.array(*[F.col(str(i)) for i in range(len(settings))])
    whole = levels.select("fold", *KEPT, quantiles.alias("_q"))
    return stage(monotone_quantiles(whole, "_q", params.quantiles), "bands")
