import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.config import Controls, ModelParams, PanelParams, from_mapping
from panelkit.errors import ContractError, PanelError
from panelkit.operators import decide
from panelkit.sinks import tables

PARAMS = ModelParams()


def predictions(spark, *rows):
    return spark.createDataFrame(
        list(rows), "zip string, p50 double, ci80_width double, p10 double, p05 double"
    ).withColumns({"p90": F.col("p10") + F.col("ci80_width"), "p95": F.col("p90") + 0.01})


def order(df):
    return [r.zip for r in df.orderBy("rank").collect()]


RISKY, TIGHT = ("A", 0.10, 0.20, 0.0, -0.02), ("B", 0.06, 0.02, 0.05, 0.04)


def test_lambda_swaps_the_order(spark):
    df = predictions(spark, RISKY, TIGHT)
    assert order(decide.rank(df, 0.0)) == ["A", "B"]
    assert order(decide.rank(df, 1.0)) == ["B", "A"]


def test_ties_and_missing_scores(spark):
    nan = float("nan")
    df = predictions(spark, ("C", 0.1, 0.1, 0.0, 0.0), ("B", 0.1, 0.1, 0.0, 0.0),
                     ("N", nan, 0.1, 0.0, 0.0), ("M", None, 0.1, 0.0, 0.0), ("D", 0.2, 0.3, 0.0, 0.0))
    ranked = decide.rank(df, 1.0).orderBy("rank").collect()
    assert [r.zip for r in ranked][:3] == ["B", "C", "D"]
    assert {r.zip for r in ranked[3:]} == {"N", "M"}
    with pytest.raises(ContractError):
        decide.rank(df.drop("p50"), 1.0)


def test_eligibility_uses_the_chosen_band(spark):
    df = predictions(spark, ("A", 0.05, 0.1, -0.04, -0.06), ("B", -0.01, 0.1, 0.0, 0.0))
    assert [r.zip for r in decide.eligible(df, 0.0, 0.05, 80).collect()] == ["A"]
    assert decide.eligible(df, 0.0, 0.05, 90).count() == 0
    with pytest.raises(PanelError):
        decide.eligible(df, 0.0, 0.05, 95)
    out = spark.createDataFrame([("A",), ("A",)], "zip string")
    assert decide.eligible(df, 0.0, 0.05, 80, out).count() == 0
    assert decide.eligible(df, 0.0, 0.05, 80, ["A"]).count() == 0


def scores(spark, *values):
    return spark.createDataFrame(
        [(f"{i}", v) for i, v in enumerate(values)], "zip string, score double")


def test_allocation_is_proportional_and_sums_to_the_budget(spark):
    got = {r.zip: r.allocation for r in decide.allocate(scores(spark, 3.0, 1.0, -2.0), 400.0).collect()}
    assert got == {"0": 300.0, "1": 100.0, "2": 0.0}


def test_equal_split_when_no_score_is_positive(spark):
    got = [r.allocation for r in decide.allocate(scores(spark, -1.0, -2.0), 100.0).collect()]
    assert got == [50.0, 50.0]
    assert decide.allocate(scores(spark, 1.0).limit(0), 100.0).count() == 0


def test_scenario_moves_level_and_linked_change(spark):
    df = spark.createDataFrame(
        [("1", 6.0, 0.1, 4.0)], "zip string, MORTGAGE30US double, mortgage_delta_3m double, UNRATE double")
    row = decide.apply_scenario(df, {"MORTGAGE30US": 0.5}).first()
    assert (row.MORTGAGE30US, row.mortgage_delta_3m, row.UNRATE) == (6.5, 0.6, 4.0)
    assert df.first().MORTGAGE30US == 6.0
    with pytest.raises(ContractError):
        decide.apply_scenario(df, {"UNRATE": 1.0})
    with pytest.raises(ContractError):
        decide.apply_scenario(df.drop("MORTGAGE30US"), {"MORTGAGE30US": 1.0})
    grid = decide.scenario_grid(df, [-50, 0, 100])
    assert sorted(r.MORTGAGE30US for r in grid.collect()) == [5.5, 6.0, 7.0]
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_units(spark):
    assert decide.scenario_shift(Controls(rate_bps=50)) == {"MORTGAGE30US": 0.5}
    assert decide.scenario_shift(Controls()) == {}
    assert decide.risk_lambda(Controls(risk_tolerance="Low")) > decide.risk_lambda(
        Controls(risk_tolerance="High"))
    with pytest.raises(PanelError):
        decide.risk_lambda(Controls(risk_tolerance="None"))
    assert from_mapping(PanelParams, {"metros": ["a"]}).metros == ("a",)
    with pytest.raises(PanelError):
        from_mapping(PanelParams, {"typo": 1})


@pytest.fixture(scope="module")
def universe(spark):
    rows = [
        (f"{i:05d}", dt.date(2024, m, 1), 6.0, 0.1, 0.10 - 0.02 * i, 0.01 * (i + 1))
        for i in range(10) for m in (1, 2)
    ]
    return spark.createDataFrame(
        rows, "zip string, month date, MORTGAGE30US double, mortgage_delta_3m double, "
              "mid double, half double")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(
        [(f"{i:05d}", "East" if i < 5 else "West") for i in range(9)], "zip string, metro string")


def scorer(df):
    mid = F.col("mid") - 0.05 * (F.col("mortgage_delta_3m") - 0.1)
    half = F.col("half")
    return df.withColumns(
        {"point": mid, "p50": mid, "p05": mid - 1.6 * half, "p10": mid - half, "p90": mid + half,
         "p95": mid + 1.6 * half, "ci80_width": 2 * half, "ci90_width": 3.2 * half})


def run(universe, lookup, **changes):
    controls = Controls(**{"max_downside": 0.5, "budget": 1000.0, **changes})
    return decide.decide(controls, decide.latest_snapshot(universe), lookup, scorer)


def zips(df):
    return {r.zip for r in df.select("zip").collect()}


def test_decision_end_to_end(universe, lookup):
    made = run(universe, lookup)
    total = made.summary.first()
    assert (total.evaluated, total.qualified) == (10, 6)
    assert total.deployed == pytest.approx(1000.0) and total.unallocated == pytest.approx(0.0)
    ranks = sorted(r["rank"] for r in made.ranked.collect())
    assert ranks == list(range(1, 11))
    assert {r.metro for r in made.ranked.collect()} == {"East", "West", "Unknown"}


def test_every_control_changes_the_outcome(universe, lookup):
    base = run(universe, lookup)
    assert zips(run(universe, lookup, min_roi=0.05).qualifying) < zips(base.qualifying)
    tight = zips(run(universe, lookup, max_downside=0.01).qualifying)
    assert tight < zips(base.qualifying)
    assert zips(run(universe, lookup, max_downside=0.01, ci_level=90).qualifying) <= tight
    assert zips(run(universe, lookup, metros=("East",)).ranked) == {f"{i:05d}" for i in range(5)}
    shocked = run(universe, lookup, rate_bps=100)
    assert zips(shocked.qualifying) < zips(base.qualifying)
    out = run(universe, lookup, exclude_zips=("00000",))
    assert "00000" not in zips(out.qualifying) and "00000" in zips(out.ranked)
    assert run(universe, lookup, budget=5.0).summary.first().deployed == pytest.approx(5.0)


def test_nothing_qualifies_leaves_the_budget(universe, lookup):
    total = run(universe, lookup, min_roi=5.0).summary.first()
    assert (total.qualified, total.deployed, total.unallocated) == (0, 0.0, 1000.0)


def test_views(universe, lookup, tmp_path, spark):
    made = run(universe, lookup)
    drawn = {r.zip: r for r in decide.map_frame(made.ranked, made.qualifying).collect()}
    assert len(drawn) == 10
    assert drawn["00009"].qualifies is False and drawn["00009"].allocation is None
    assert drawn["00009"].allocation_text == "—" and drawn["00009"].color_value == -0.05
    shown = decide.display_table(made.qualifying, 90)
    first = shown.orderBy("rank").first()
    assert first.pred_pct == pytest.approx(10.0)
    assert first.ci_lo_pct == pytest.approx((0.10 - 0.016) * 100)
    top = [r.allocation for r in decide.top_allocations(shown, 3).collect()]
    assert top == sorted(top) and len(top) == 3
    cards = decide.entity_cards(made.ranked, made.qualifying, 80)
    assert cards.count() == 10 and cards.filter("allocation is null").count() == 4
    tables.export_allocation(shown, str(tmp_path / "out"), 90, single_file=True)
    header = spark.read.csv(str(tmp_path / "out"), header=True).columns
    assert header == ["rank", "zip", "metro", "predicted_3mo_change_pct", "ci90_low_pct",
                      "ci90_high_pct", "risk_adjusted_score_pp", "allocated_usd",
                      "allocated_share_pct"]


def test_concentration(spark):
    shown = spark.createDataFrame(
        [(30.0, 300.0), (5.0, 50.0), (0.0, 0.0)], "share_pct double, allocation double")
    row = decide.concentration_note(decide.concentration(shown)).first()
    assert (row.funded, row.concentrated) == (2, True)
    assert row.note == "Concentrated: 30.0% of the budget goes to one zip; 2 of 3 qualifying zips get a share."
    assert decide.concentration(shown.limit(0)).first().concentrated is False


def test_summary_of_universe(universe, lookup):
    row = decide.universe_summary(universe, lookup).first()
    assert (row.rows, row.zips, row.metros, row.metro_matched, row.metro_unmatched) == (20, 10, 2, 18, 2)
    assert [r.metro for r in decide.metro_options(lookup).collect()] == ["East", "West"]


def test_ranking_is_the_same_when_spread(universe, lookup):
    scored = scorer(decide.latest_snapshot(universe))
    plain = {r.zip: r["rank"] for r in decide.rank(scored, 0.25).collect()}
    spread = {r.zip: r["rank"] for r in decide.rank(scored, 0.25, max_group=3).collect()}
    assert plain == spread
