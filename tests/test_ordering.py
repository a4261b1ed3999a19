"""The distributed paths give the numbers of the plain window and aggregate."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators.ordering import average_ranks, position, running_total
from panelkit.operators.quantiles import grouped_percentiles
from panelkit.operators.trailing import trailing_cells
from panelkit.staging import stage


@pytest.fixture(scope="module")
def rows(spark):
    """Group 'a' holds two thirds of the rows, and one value a third of those."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        group = "a" if i % 3 else rng.choice("bcd")
        value = 5.0 if i % 4 == 0 else round(rng.uniform(0, 50), 1)
        data.append((i, group, None if i % 97 == 0 else value))
    return stage(spark.createDataFrame(data, "id int, g string, v double"), "t")


def as_dict(df, *names):
    return {r["id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_position_by_slices_equals_window(rows, by):
    order = [F.desc_nulls_last("v"), F.asc("id")]
    plain = as_dict(position(rows, order, by), "rank")
    spread = as_dict(position(rows, order, by, max_group=40), "rank")
    assert plain == spread and len(plain) == 900
    if not by:
        assert sorted(v[0] for v in spread.values()) == list(range(1, 901))


def test_running_total_with_weights(rows):
    order = [F.asc_nulls_first("v"), F.asc("id")]
    plain = as_dict(running_total(rows, order, ["g"], F.col("id")), "running")
    spread = as_dict(running_total(rows, order, ["g"], F.col("id"), max_group=30), "running")
    assert plain == spread


def test_average_ranks_both_ways(rows):
    known = stage(rows.dropna(), "t")
    plain = as_dict(average_ranks(known, "v", ["g"], "r"), "r")
    spread = as_dict(average_ranks(known, "v", ["g"], "r", max_group=25), "r")
    assert plain == spread


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("limit", [3, 25, 400])
def test_ties_over_any_number_of_slices(rows, by, limit):
    """Nulls, one value in a third of the rows, and a constant column."""
    plain = as_dict(average_ranks(rows, "v", by, "r"), "r")
    spread = average_ranks(rows, "v", by, "r", max_group=limit)
    assert as_dict(spread, "r") == plain
    constant = stage(rows.withColumn("v", F.lit(1.0)), "t")
    assert as_dict(average_ranks(constant, "v", by, "r", max_group=limit), "r") == as_dict(average_ranks(constant, "v", by, "r"), "r")


def test_percentiles_match_numpy_with_and_without_large_groups(rows):
    wanted = {"p05": ("v", 0.05), "p50": ("v", 0.5), "p90": ("v", 0.9), "id50": ("id", 0.5)}
    data = rows.toPandas()
    for limit in (10_000, 100, 10):
        got = grouped_percentiles(
            rows, ["g"], wanted, [F.count("v").alias("n")], max_group=limit
        ).collect()
        assert len(got) == 4
        for r in got:
            mine = data[data.g == r.g]
            values = mine.v.dropna().to_numpy()
            assert r.n == len(values)
            for name, p in (("p05", 5), ("p50", 50), ("p90", 90)):
                assert r[name] == pytest.approx(np.percentile(values, p), abs=1e-9)
            assert r.id50 == pytest.approx(np.percentile(mine.id, 50))


def test_trailing_cells_both_ways_and_by_hand(spark):
    """Gaps of months, a missing key, missing values, and a key with half of the rows."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        key = "hot" if i % 2 else rng.choice(["a", "b", None])
        month = rng.choice([1, 2, 3, 4, 9, 10, 20]) if key != "a" else rng.choice([5, 30])
        rows.append((key, month, None if i % 50 == 0 else round(rng.uniform(0, 9), 1), i % 7))
    df = stage(spark.createDataFrame(rows, "k string, m int, v double, w int"), "t")
    args = (["k"], "m", {"mid": "v", "mid_w": "w"}, {"total": F.col("w")}, (3, 1))
    want = []
    for key in ("hot", "a", "b", None):
        for span in (3, 1):
            for end in range(1, 33):
                own = [r for r in rows if r[0] == key and end - span < r[1] <= end]
                if own:
                    v = [r[2] for r in own if r[2] is not None]
                    want.append((key, end, span, len(own), sum(r[3] for r in own), float(np.median(v)) if v else None, float(np.median([r[3] for r in own]))))
    names = ("k", "end_month", "span", "n", "total", "mid", "mid_w")
    order = lambda r: tuple(map(str, r))
    for limit in (10_000, 250, 100, 5):
        got = [tuple(r[n] for n in names) for r in trailing_cells(df, *args, max_group=limit).collect()]
        for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_trailing_tasks_follow_the_rows_and_batches_cut_no_key(spark, monkeypatch):
    from panelkit.operators import trailing

    data = [(k, m, float(i % 5) if i % 9 else None) for k in range(40) for i, m in enumerate([1, 2, 2, 4, None, 9] * (1 + k % 4))]
    df = stage(spark.createDataFrame(data, "k int, m int, v double"), "t")
    args = (["k"], "m", {"mid": "v"}, {"total": F.col("v")}, (3, 1))
    want = sorted(map(str, trailing_cells(df, *args).collect()))
    monkeypatch.setattr(trailing, "BATCH_ROWS", 1)
    monkeypatch.setattr(trailing, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        small = trailing_cells(df, *args, rows=650)
        assert small.rdd.getNumPartitions() == 7
        assert sorted(map(str, small.collect())) == want and len(want) == 40 * 13
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_do_not_copy_rows_before_the_exchange(spark, folder):
    from panelkit.sources import bind

    plan = bind.tracker(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "Generate" not in below and plan.count("RepartitionByExpression") == 1


def test_plan_of_position_below_limit_has_no_second_shuffle(rows):
    df = position(rows, [F.asc("id")], ["g"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
