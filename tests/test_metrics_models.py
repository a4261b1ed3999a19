import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.config import ModelParams, PanelParams
from panelkit.errors import ContractError
from panelkit.operators import attribution, explain, metrics, models, monitor, split
from panelkit.plans import training
from panelkit.staging import stage

MONTHS = [split.shift_month(dt.date(2018, 1, 1), i) for i in range(64)]
PANEL = PanelParams()
QUICK = training.quick_params()


@pytest.fixture(scope="module")
def table(spark):
    """Linear target with noise; one feature has gaps, the last 3 months no label."""
    rng = np.random.default_rng(3)
    rows = []
    for z in range(30):
        for i, m in enumerate(MONTHS):
            a, b, c = rng.normal(size=3)
            y = 0.05 * a - 0.03 * b + 0.01 * (c > 0) + rng.normal(scale=0.01)
            rows.append((f"{z:05d}", m, float(a), None if rng.random() < 0.1 else float(b),
                         float(c), float(a) / 10, z == 0, None if i >= 61 else float(y)))
    df = spark.createDataFrame(
        rows, "zip string, month date, a double, b double, c double, price_mom_3m double, "
              "low_volume boolean, target double")
    return stage(split.assign_split(df.withColumn("target_outlier", F.lit(False))), "t")


@pytest.fixture(scope="module")
def train_rows(table):
    return split.drop_flagged(table.filter("split = 'train'"), ["low_volume"])


COLUMNS = ["a", "b", "c"]


def frame(spark, rows):
    return spark.createDataFrame(
        [(dt.date(2024, m, 1), p, y) for m, p, y in rows], "month date, prediction double, target double")


def test_metrics_against_pandas(spark):
    rng = np.random.default_rng(1)
    rows = [(m, float(round(p, 1)), float(y)) for m in (1, 2, 3)
            for p, y in rng.normal(size=(40, 2))]
    pdf = pd.DataFrame(rows, columns=["m", "p", "y"])
    for limit in (1_000_000, 7):
        got = {r.month: r for r in metrics.metrics_report(
            stage(frame(spark, rows), "p"), max_group=limit).collect()}
        corr = []
        for m in (1, 2, 3):
            g = pdf[pdf.m == m]
            row = got[dt.date(2024, m, 1)]
            assert row.rmse == pytest.approx(np.sqrt(((g.p - g.y) ** 2).mean()))
            assert row.dir_acc == pytest.approx((np.sign(g.p) == np.sign(g.y)).mean())
            want = g.p.rank().corr(g.y.rank())
            assert row.rank_corr == pytest.approx(want)
            corr.append(want)
        assert got[None].rank_corr == pytest.approx(np.mean(corr))
        assert got[None].mae == pytest.approx((pdf.p - pdf.y).abs().mean())
        assert got[None].n == 120


def test_constant_side_has_no_rank_correlation(spark):
    report = metrics.metrics_report(frame(spark, [(1, 0.0, 1.0), (1, 0.0, 2.0), (2, 1.0, 1.0), (2, 2.0, 3.0)]))
    got = {r.month: r.rank_corr for r in report.collect()}
    assert got[dt.date(2024, 1, 1)] is None
    assert got[dt.date(2024, 2, 1)] == pytest.approx(1.0) and got[None] == pytest.approx(1.0)


def test_zero_prediction_only_hits_zero(spark):
    row = metrics.group_metrics(frame(spark, [(1, 0.0, 0.0), (1, 0.0, 0.1)]), ["month"]).first()
    assert row.dir_acc == 0.5


def test_best_marker_and_selection(spark):
    df = spark.createDataFrame(
        [(0, 0.5, "x"), (1, float("nan"), "y"), (2, 0.5, "z"), (3, None, "w")],
        "grid_pos int, rank_corr double, model string")
    assert models.select_best(df).first().grid_pos == 0
    marked = metrics.mark_best(df.filter("grid_pos <> 1"))
    assert {r.model for r in marked.filter("is_best").collect()} == {"x", "z"}


def test_grid_order(spark):
    grid = {"maxDepth": (3, 5), "maxIter": (7,), "stepSize": (0.1, 0.2)}
    assert models.expand_grid(grid)[1] == {"maxDepth": 3, "maxIter": 7, "stepSize": 0.2}
    assert models.grid_table(spark, grid).count() == 4
    assert len(models.expand_grid(ModelParams().grid)) == 12


def test_drift(spark):
    ref = spark.createDataFrame([(float(i), float(i % 3), 1.0) for i in range(30)], "f double, g double, k double")
    win = ref.withColumn("f", F.col("f") + 20)
    got = [(r.feature, r["shift"]) for r in metrics.drift_stats(win, ref, ["f", "g", "k"]).collect()]
    assert got[0][0] == "f" and got[0][1] == pytest.approx(20 / np.std(np.arange(30), ddof=1))
    assert got[1] == ("g", 0.0) and got[2] == ("k", None)


@pytest.mark.parametrize("fresh,accept,degraded,promote,code", [
    (0.11, False, False, True, 0), (0.25, False, True, False, 3), (0.25, True, True, True, 0),
    (float("nan"), False, False, True, 0), (None, False, False, True, 0),
    (float("inf"), False, False, True, 0)])
def test_gate(spark, fresh, accept, degraded, promote, code):
    df = spark.createDataFrame([(fresh, 0.10)], "fresh_rmse double, baseline_rmse double")
    row = monitor.degradation_gate(df, 2.0, accept).first()
    assert (row.degraded, row.promote, row.exit_code) == (degraded, promote, code)
    assert (row.alert is not None) == degraded


def test_ridge_equals_the_closed_form(table, train_rows):
    fitted = models.fit_model(train_rows, COLUMNS, "ridge", {"alpha": 5.0}, 1)
    pdf = train_rows.select(*COLUMNS, "target").toPandas()
    x = pdf[COLUMNS].fillna(pdf[COLUMNS].median())
    z = ((x - x.mean()) / x.std(ddof=0)).to_numpy()
    y = pdf.target.to_numpy()
    beta = np.linalg.solve(z.T @ z + 5.0 * np.eye(3), z.T @ (y - y.mean()))
    want = z @ beta + y.mean()
    got = fitted.transform(train_rows).select("prediction").toPandas().prediction
    assert np.abs(np.sort(got) - np.sort(want)).max() < 1e-4


def test_additivity_of_ridge_and_trees(table, train_rows):
    snapshot = table.filter(F.col("month") == F.lit(MONTHS[-1]))
    ridge = models.fit_model(train_rows, COLUMNS, "ridge", {"alpha": 1.0}, 1)
    parts = attribution.ridge_contributions(ridge, snapshot)
    assert attribution.additivity_error(parts).first().max_error < 1e-9
    for kind, settings in (("boosted", QUICK.boosted), ("forest", QUICK.forest)):
        fitted = models.fit_model(train_rows, COLUMNS, kind, settings, 1)
        parts = attribution.tree_contributions(fitted, snapshot)
        row = attribution.additivity_error(parts).first()
        assert row.rows == 30 and row.max_error < 1e-9
        leading = explain.mean_importance(parts).first().feature
        assert leading == "a"


def test_bands_are_ordered_and_calibrated(table, train_rows):
    """A value per row, never crossed, covering what they claim on every fold."""
    params = replace(QUICK, band_trees=60, band_least=10)
    bands = models.fit_bands(train_rows, COLUMNS, params)
    held = split.drop_flagged(table.filter("split = 'test'"), ["low_volume"])
    out = stage(bands.transform(held), "banded")
    bad = out.filter("p05 > p10 or p10 > p50 or p50 > p90 or p90 > p95 or ci80_width < 0")
    assert bad.isEmpty() and out.count() == held.count()
    assert out.select("p50").distinct().count() > 0.9 * held.count()
    folds = models.calibrate(table, COLUMNS, PANEL, params).collect()
    assert len(folds) == 5
    pooled = {r.band: r for r in metrics.calibration_table(models.calibrate(table, COLUMNS, PANEL, params)).collect()}
    assert abs(pooled["80"].gap) <= 0.1 and abs(pooled["90"].gap) <= 0.1
    assert all(r.coverage_80 <= r.coverage_90 for r in folds)


def test_crossed_quantiles_are_sorted(spark):
    df = spark.createDataFrame([([0.5, 0.1, 0.3, 0.2, 0.4],)], "q array<double>")
    row = models.monotone_quantiles(df, "q").first()
    assert [row.p05, row.p10, row.p50, row.p90, row.p95] == [0.1, 0.2, 0.3, 0.4, 0.5]
    assert row.ci80_width == pytest.approx(0.2) and row.ci90_width == pytest.approx(0.4)
    with pytest.raises(Exception, match="expected 5 quantiles"):
        models.monotone_quantiles(spark.createDataFrame([([0.1],)], "q array<double>"), "q").collect()


def test_cross_validation_never_sees_test_or_flagged_rows(table):
    seen = []

    def spy(train, held, columns):
        seen.append((train, held))
        return held.withColumn("prediction", F.lit(0.01))

    report = models.cross_validate(table, COLUMNS, {"spy": spy}, PANEL, QUICK).collect()
    assert len(report) == 6  # five folds and the pooled row
    for train, held in seen:
        end = held.agg(F.max("month")).first()[0]
        assert train.agg(F.max("month")).first()[0] == split.shift_month(end, -3)
        for part in (train, held):
            assert part.filter("split <> 'train' or low_volume").isEmpty()


def test_models_beat_the_naive_forecast(table):
    chosen = {k: v for k, v in models.standard_predictors(QUICK).items() if k != "naive_momentum"}
    report = models.holdout(table, COLUMNS, chosen, QUICK)
    pooled = {r.model: r for r in report.filter("month is null").collect()}
    assert pooled["naive_zero"].rank_corr is None
    for name in ("linear", "random_forest", "boosted"):
        assert pooled[name].rmse < pooled["naive_zero"].rmse and pooled[name].rank_corr > 0.6
    row = metrics.headline_delta(report.filter("month is null"), "linear", "boosted").first()
    assert row.delta == pytest.approx(pooled["linear"].rank_corr - pooled["boosted"].rank_corr)
    with pytest.raises(ContractError):
        models.holdout(table.filter("split <> 'test'"), COLUMNS, chosen, QUICK)


def test_train_retrain_and_promotion(spark, table, tmp_path):
    from panelkit.sinks import runs, tables

    root = str(tmp_path / "work")
    with pytest.raises(Exception, match="missing or empty"):
        runs.selected_settings(spark, f"{root}/runs")
    narrow = table.drop("price_mom_3m")
    made = training.train_and_save(narrow, root, "v1", PANEL, QUICK)
    settings, baseline = runs.selected_settings(spark, f"{root}/runs")
    assert settings["maxDepth"] in (2.0, 3.0) and baseline > 0
    assert tables.latest_path(spark, f"{root}/models").endswith("v1")

    done = training.retrain(narrow, root, "v2", PANEL, QUICK)
    assert done.decision.exit_code == 0 and done.drift.count() == 3
    assert tables.latest_path(spark, f"{root}/models").endswith("v2")

    spoiled = narrow.withColumn("target", F.when(
        F.col("month") == F.lit(MONTHS[60]), F.col("target") + 5).otherwise(F.col("target")))
    bad = training.retrain(spoiled, root, "v3", PANEL, QUICK)
    assert (bad.decision.degraded, bad.decision.exit_code) == (True, 3)
    assert tables.latest_path(spark, f"{root}/models").endswith("v2")
    assert runs.runs(spark, f"{root}/runs").count() == 3
    assert runs.last_run(spark, f"{root}/runs", "retrain").version == "v3"

    latest = table.filter(F.col("month") == F.lit(MONTHS[-1]))
    point = models.TreeModel.load(spark, f"{root}/models/versions/v1/point")
    bands = models.BandModel.load(spark, f"{root}/models/versions/v1/bands")
    a = {r.zip: r for r in models.score(latest, made.point, made.bands).collect()}
    b = {r.zip: r for r in models.score(latest, point, bands).collect()}
    assert all(a[z].point == b[z].point and a[z].p05 == b[z].p05 for z in a)


def counted_fits(monkeypatch):
    """Numbers of ensembles of each fit that is made from now on."""
    from panelkit.operators import boosting

    made, real = [], boosting._fit

    def fit(samples, columns, settings, *rest):
        made.append(len(settings))
        return real(samples, columns, settings, *rest)

    monkeypatch.setattr(boosting, "_fit", fit)
    return made


def test_point_and_bands_are_one_fit_and_the_same_trees(table, train_rows, monkeypatch):
    report = models.grid_table(table.sparkSession, QUICK.grid).withColumns({"rank_corr": -F.col("grid_pos").cast("double"), "rmse": F.lit(1.0)})
    monkeypatch.setattr(models, "grid_search", lambda *a: report)
    fits = counted_fits(monkeypatch)
    made = training.train(table, PANEL, QUICK)
    assert fits == [1 + len(QUICK.quantiles)]
    columns = training.feature_columns(table)
    point = models.fit_model(train_rows, columns, "boosted", made.settings, QUICK.seed)
    bands = models.fit_bands(train_rows, columns, QUICK, made.settings)
    for a, b in zip((made.point, *made.bands.models), (point, *bands.models)):
        assert a.base == b.base and len(a.trees) == len(b.trees)
        assert all(np.array_equal(x[k], y[k], equal_nan=k == "cut") for x, y in zip(a.trees, b.trees) for k in x)


def test_boosted_models_of_the_holdout_are_one_fit(table, train_rows, monkeypatch):
    chosen = {k: v for k, v in models.standard_predictors(QUICK).items() if k in ("naive_zero", "leafwise", "boosted")}
    fits = counted_fits(monkeypatch)
    together = models.holdout(table, COLUMNS, chosen, QUICK).collect()
    assert fits == [2]
    alone = [r for n, fn in chosen.items() for r in models.holdout(table, COLUMNS, {n: fn}, QUICK).collect()]
    plain = lambda rows: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)
    assert plain(together) == plain(alone)
