"""Every query with SQL gives the rows of that SQL; the others run and hold."""

import pytest

import __spark_entry__ as contract
import panelkit.plans.contract_queries  # noqa: F401
import panelkit.plans.landing_queries  # noqa: F401
import panelkit.plans.model_queries  # noqa: F401
from panelkit.plans import oracle as panel_oracle
from panelkit.plans import queries as panel_queries
from oracle_compare import connect, differences

QUERIES, SQL = panel_queries.QUERIES, panel_oracle.SQL
# Nothing qualifies or nothing is wrong: no row is the right answer there.
MAY_BE_EMPTY = set()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match_the_sql(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert differences(df, duck, SQL[name]) is None
    assert name in MAY_BE_EMPTY or not df.isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize(
    "name", ["tracker_dedup_latest", "rank_universe", "baseline_comparison", "peer_median",
             "interval_coverage", "scenario_grid", "value_percentiles", "rank_corr_with_missing", "decide_full"])
def test_large_group_path_gives_the_same_rows(spark, folder, duck, name):
    spark.conf.set("spark.panelkit.maxGroupRows", "20")
    try:
        assert differences(QUERIES[name](spark, folder), duck, SQL[name]) is None
    finally:
        spark.conf.unset("spark.panelkit.maxGroupRows")


def test_entry(spark):
    assert contract.entry(spark).count() == 25
