import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from panelkit.config import TRACKER_METRICS, PanelParams
from panelkit.errors import ContractError, MissingInputError
from panelkit.operators import tidy
from panelkit.sources import readers

SCHEMA = (
    "period_begin date, period_end date, region_zip string, property_type string, "
    + ", ".join(f"{m} double" for m in TRACKER_METRICS)
)
D = dt.date


def tracker(spark, *rows):
    made = []
    for begin, end, region, changes in rows:
        values = dict.fromkeys(TRACKER_METRICS, 1.0) | {"homes_sold": 20.0} | changes
        made.append((begin, end, region, "All Residential", *[values[m] for m in TRACKER_METRICS]))
    return spark.createDataFrame(made, SCHEMA)


WHOLE = (D(2024, 1, 1), D(2024, 3, 31))


def test_only_whole_windows_survive_and_belong_to_their_last_month(spark):
    df = tracker(
        spark,
        (*WHOLE, "Zip Code: 210", {}),
        (D(2024, 3, 1), D(2024, 3, 31), "Zip Code: 210", {}),
        (D(2024, 3, 25), D(2024, 3, 31), "Zip Code: 210", {}),
        (D(2023, 12, 1), D(2024, 2, 29), "Zip Code: 210", {}),
    )
    got = sorted((r.zip, r.month) for r in tidy.tidy_tracker(df).collect())
    assert got == [("00210", D(2024, 2, 1)), ("00210", D(2024, 3, 1))]


def test_no_key_or_no_price_drops_the_row(spark):
    df = tracker(
        spark,
        (*WHOLE, "no digits", {}),
        (*WHOLE, "Zip Code: 5", {"median_sale_price": None}),
        (*WHOLE, "Zip Code: 6", {}),
    )
    assert [r.zip for r in tidy.tidy_tracker(df).collect()] == ["00006"]


@pytest.mark.parametrize("flip", [False, True])
def test_dedup_does_not_depend_on_row_order(spark, flip):
    rows = [(*WHOLE, "1", {"median_sale_price": 100.0}), (*WHOLE, "1", {"median_sale_price": 101.0})]
    df = tracker(spark, *(rows[::-1] if flip else rows))
    assert [r.median_sale_price for r in tidy.tidy_tracker(df).collect()] == [101.0]


def test_dedup_missing_value_wins(spark):
    df = tracker(spark, (*WHOLE, "1", {"homes_sold": 50.0}), (*WHOLE, "1", {"homes_sold": None}))
    assert [r.homes_sold for r in tidy.tidy_tracker(df).collect()] == [None]


def test_low_volume_flag(spark):
    df = tracker(
        spark,
        (*WHOLE, "1", {"homes_sold": 9.0}),
        (*WHOLE, "2", {"homes_sold": 10.0}),
        (*WHOLE, "3", {"homes_sold": None}),
    )
    got = {r.zip: r.low_volume for r in tidy.tidy_tracker(df).collect()}
    assert got == {"00001": True, "00002": False, "00003": True}


def test_column_without_any_value_is_dropped(spark):
    df = tracker(spark, (*WHOLE, "1", {"price_drops": None}))
    out = tidy.drop_empty_columns(tidy.tidy_tracker(df), TRACKER_METRICS)
    assert "price_drops" not in out.columns and "inventory" in out.columns


def test_metro_filter_is_optional(spark):
    df = tracker(spark, (*WHOLE, "1", {}), (*WHOLE, "2", {})).withColumn(
        "metro", F.when(F.col("region_zip") == "1", "A").otherwise("B")
    )
    assert tidy.select_rows(df, PanelParams()).count() == 2
    assert tidy.select_rows(df, PanelParams(metros=("B",))).count() == 1


def test_wide_to_long(spark):
    df = spark.createDataFrame(
        [("210", "NY", "10.5", None), ("210", "NY", "11.5", "7"), ("x", "NY", "1", "2")],
        "RegionName string, State string, `2024-01-31` string, `2024-02-29` string",
    )
    got = sorted((r.zip, r.month, r.zhvi) for r in tidy.tidy_wide(df).collect())
    assert got == [("00210", D(2024, 1, 1), 11.5), ("00210", D(2024, 2, 1), 7.0)]
    with pytest.raises(ContractError):
        tidy.tidy_wide(df.select("RegionName", "State"))


def observations(spark, *rows):
    return spark.createDataFrame(
        [(s, D.fromisoformat(d), v) for s, d, v in rows], "series string, date date, value string"
    )


def test_macro_mean_gap_fill_and_trailing_months(spark):
    df = observations(
        spark,
        ("W", "2024-01-05", "6"), ("W", "2024-01-12", "7"), ("W", "2024-02-02", "."),
        ("W", "2024-03-01", "8"), ("W", "2024-04-05", "9"),
        ("M", "2024-01-01", "1"), ("M", "2024-02-01", "."), ("M", "2024-03-01", "3"),
        ("M", "2024-04-01", "."),
        ("Z", "2024-02-01", "5"),
    )
    got = {r.month: r for r in tidy.tidy_macro(df, ["W", "M", "Z"]).collect()}
    assert sorted(got) == [D(2024, m, 1) for m in (1, 2, 3, 4)]
    assert got[D(2024, 1, 1)].W == 6.5
    assert got[D(2024, 2, 1)].W == 6.5 and got[D(2024, 2, 1)].M == 1.0
    assert got[D(2024, 4, 1)].M is None and got[D(2024, 3, 1)].Z is None


def test_month_missing_from_every_series_has_no_row(spark):
    df = observations(spark, ("M", "2024-01-01", "1"), ("M", "2024-02-01", "."), ("M", "2024-03-01", "3"))
    assert tidy.tidy_macro(df, ["M"]).count() == 2


def test_metro_majority_and_tie(spark):
    counts = spark.createDataFrame(
        [("Zip Code: 1", "B", 40), ("Zip Code: 1", "A", 5), ("Zip Code: 2", "B", 7),
         ("Zip Code: 2", "A", 4), ("2", "A", 3), ("none", "A", 1), ("3", None, 9)],
        "region_zip string, metro string, n bigint",
    )
    got = {r.zip: r.metro for r in tidy.resolve_metro(counts).collect()}
    assert got == {"00001": "B", "00002": "A"}
    assert tidy.resolve_metro(counts.limit(0)).count() == 0


def test_dedup_is_cut_down_before_the_shuffle(spark):
    df = tracker(spark, (*WHOLE, "1", {}))
    plan = tidy.tidy_tracker(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_read_tracker_tsv(spark, tmp_path):
    import gzip

    header = ["PERIOD_BEGIN", "PERIOD_END", "REGION", "PROPERTY_TYPE", "PARENT_METRO_REGION",
              "MEDIAN_SALE_PRICE", "HOMES_SOLD", "INVENTORY", "NEW_LISTINGS", "MEDIAN_DOM",
              "AVG_SALE_TO_LIST", "SOLD_ABOVE_LIST", "PRICE_DROPS", "EXTRA"]
    row = ["2024-01-01", "2024-03-31", "Zip Code: 0210", "All Residential", "Metro", "100.5",
           "12", "NA", "3", "4", "0.9", "0.1", "NA", "x"]
    path = tmp_path / "t.tsv.gz"
    path.write_bytes(gzip.compress(("\t".join(header) + "\n" + "\t".join(row) + "\n").encode()))
    df = readers.read_tracker(spark, str(path), partitions=2)
    got = df.first()
    assert got.median_sale_price == 100.5 and got.inventory is None and got.metro == "Metro"
    assert tidy.tidy_tracker(df).first().zip == "00210"
    with pytest.raises(MissingInputError):
        readers.read_tracker(spark, str(tmp_path / "absent.tsv"))


def test_read_series_json(spark, tmp_path):
    for name in ("AAA", "BBB"):
        body = {"count": 1, "observations": [{"date": "2024-01-05", "value": "3.5", "x": 1},
                                             {"date": "2024-02-05", "value": "."}]}
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    df = readers.read_series(spark, str(tmp_path))
    assert df.count() == 4 and {r.series for r in df.collect()} == {"AAA", "BBB"}
    monthly = tidy.tidy_macro(df, ["AAA", "BBB"])
    assert monthly.first().AAA == 3.5


def test_read_wide_keeps_zeros(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("RegionName,2024-01-31\n00501,10\n")
    assert tidy.tidy_wide(readers.read_wide(spark, str(path))).first().zip == "00501"
