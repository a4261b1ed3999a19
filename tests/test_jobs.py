"""The whole way: raw sources to a decision on fitted models."""

import inspect
import threading

import pytest
from pyspark.sql import functions as F

from panelkit.config import Controls
from panelkit.errors import ContractError
from panelkit.operators import decide, models
from panelkit.operators.features import feature_columns
from panelkit.plans import build, landing_queries, model_queries, training
from panelkit.plans.queries import MODEL
from panelkit.sources import bind
from panelkit.staging import application_folder, exists


@pytest.fixture(scope="module")
def features(spark, folder):
    panel = build.conform(
        bind.tracker(spark, folder),
        bind.index(spark, folder),
        bind.macro_observations(spark, folder),
        bind.PARAMS,
    )
    return build.feature_table(panel, bind.PARAMS)


def test_checked_build_gives_the_bound_features(spark, folder, features):
    assert "price_drops" not in features.columns
    assert all(f.metadata.get("comment") for f in features.schema.fields)
    other = build.bound_features(spark, folder).select(*features.columns)
    keys = ["zip", "month", "split", "low_volume"]
    assert features.select(*keys).exceptAll(other.select(*keys)).isEmpty()
    assert features.count() == other.count()


def test_misaligned_index_aborts_the_build(spark, folder):
    index = bind.index(spark, folder).withColumn("zip", F.concat("zip", F.lit("0")))
    with pytest.raises(ContractError, match="misaligned"):
        build.conform(
            bind.tracker(spark, folder), index, bind.macro_observations(spark, folder), bind.PARAMS
        )


def test_decision_on_fitted_models(spark, folder, features):
    params = training.quick_params()
    columns = feature_columns(features)
    rows = features.filter("split = 'train' and not low_volume and not target_outlier")
    point = models.fit_model(rows, columns, "ridge", {"alpha": 1.0}, 1)
    bands = models.fit_bands(rows, columns, params)
    made = decide.decide(
        Controls(max_downside=1.0, min_roi=-1.0, budget=100.0),
        decide.latest_snapshot(features),
        build.bound_lookup(spark, folder),
        lambda df: models.score(df, point, bands),
    )
    total = made.summary.first()
    assert total.evaluated == total.qualified > 0
    assert total.deployed == pytest.approx(100.0)


def test_tables_are_written_once_and_again_when_lost(spark, folder):
    calls = []

    def make(session, path):
        calls.append(path)
        return session.range(3)

    for _ in range(2):
        assert build.written_once(spark, folder, "probe", make).count() == 3
    assert len(calls) == 1 and exists(spark, application_folder(spark))
    key = next(k for k in build._WRITTEN if k[1] == "probe")
    build._WRITTEN[key] += "-gone"
    assert build.written_once(spark, folder, "probe", make).count() == 3 and len(calls) == 2


def test_the_cycle_trains_with_the_full_settings(spark, folder, monkeypatch):
    """Both trainings of the query get all trees; only this test replaces them by few."""
    asked = []

    def noted(real):
        def call(*args, **kwargs):
            given = inspect.signature(real).bind(*args, **kwargs)
            asked.append(given.arguments["params"])
            given.arguments["params"] = training.quick_params(MODEL)
            return real(*given.args, **given.kwargs)

        return call

    for name in ("train_and_save", "retrain_from_files"):
        monkeypatch.setattr(training, name, noted(getattr(training, name)))
    monkeypatch.setattr(landing_queries, "written_once", lambda session, path, name, make: make(session, path))
    row = landing_queries._retrained(spark, folder).first()
    assert asked == [MODEL, MODEL]
    assert row.latest == ("v2" if row.promote else "v1")


def test_compared_models_are_fitted_side_by_side(spark, folder, monkeypatch):
    """Each waits for all others to have begun, which one after the other never ends."""
    together = threading.Barrier(len(model_queries.PREDICTORS), timeout=60)

    def begun(session, path, name):
        together.wait()
        return session.createDataFrame([(name, None, 1.0)], "model string, month date, rmse double")

    monkeypatch.setattr(model_queries, "_cv", begun)
    assert [r.model for r in model_queries._compared(spark, folder).collect()] == list(model_queries.PREDICTORS)
