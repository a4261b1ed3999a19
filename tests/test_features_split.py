import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from panelkit.config import PanelParams
from panelkit.errors import ContractError
from panelkit.operators import contracts, features, panel, split

D = dt.date


def month(i):
    return D(2020 + (i // 12), i % 12 + 1, 1)


def make_panel(spark, zips=2, months=30, skip=(), scale=None):
    rows = []
    for z in range(zips):
        for i in range(months):
            if month(i) in skip:
                continue
            price = 100000.0 * (z + 1) + 1000.0 * i
            if scale and scale[0] == (z, i):
                price *= scale[1]
            rows.append((f"{z:05d}", month(i), price, 20.0 + i, 50.0 + i, 30.0, 9.0, 0.9, 0.1,
                         False, 90000.0 + 10 * i, 3.0 + 0.1 * i, 4.0, 200.0, 1.0))
    return spark.createDataFrame(
        rows,
        "zip string, month date, median_sale_price double, homes_sold double, inventory double, "
        "new_listings double, median_dom double, avg_sale_to_list double, "
        "sold_above_list double, low_volume boolean, zhvi double, MORTGAGE30US double, "
        "UNRATE double, CPIAUCSL double, HOUST double",
    )


def by_key(df):
    return {(r.zip, r.month): r for r in df.collect()}


def test_label_and_momentum_are_exact(spark):
    got = by_key(features.build_features(make_panel(spark)))
    row = got[("00000", month(12))]
    assert row.target == pytest.approx(115000 / 112000 - 1, abs=1e-12)
    assert row.price_mom_1m == pytest.approx(112000 / 111000 - 1, abs=1e-12)
    assert row.price_mom_12m == pytest.approx(112000 / 100000 - 1, abs=1e-12)
    assert row.mortgage_delta_3m == pytest.approx(0.3)
    assert row.month_of_year == 1
    assert got[("00000", month(27))].target is None
    assert got[("00000", month(0))].price_mom_1m is None


def test_lags_follow_the_calendar_not_the_row(spark):
    got = by_key(features.build_features(make_panel(spark, skip={D(2020, 4, 1)})))
    assert got[("00000", D(2020, 5, 1))].price_mom_1m is None
    assert got[("00000", D(2020, 1, 1))].target is None
    assert got[("00000", D(2020, 6, 1))].price_mom_3m == pytest.approx(105 / 102 - 1)


def test_outlier_is_flagged_and_kept(spark):
    df = features.build_features(make_panel(spark, scale=((0, 10), 10.0)))
    got = by_key(df)
    assert got[("00000", month(7))].target_outlier is True
    assert got[("00000", month(28))].target_outlier is False
    assert len(got) == 60


def test_zero_base_gives_missing(spark):
    df = make_panel(spark, zips=1, months=6).withColumn(
        "homes_sold", F.lit(0.0)).withColumn("inventory", F.lit(0.0))
    row = by_key(features.build_features(df))[("00000", month(4))]
    assert row.listings_to_sales is None and row.inventory_chg_3m is None


def test_no_feature_looks_ahead(spark):
    base = make_panel(spark)
    spoiled = base.withColumn(
        "median_sale_price",
        F.when(F.col("month") > F.lit(month(15)), F.col("median_sale_price") * 7).otherwise(
            F.col("median_sale_price")),
    )
    diff = features.lookahead_differences(
        features.build_features(base), features.build_features(spoiled), month(15))
    assert diff.isEmpty()
    labels = features.lookahead_differences(
        features.build_features(base), features.build_features(spoiled), month(15), ignore=())
    assert not labels.isEmpty()


def test_all_lags_share_one_exchange(spark):
    plan = features.build_features(make_panel(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Window") == 1


def test_dictionary_covers_and_rejects(spark):
    df = features.document(features.build_features(make_panel(spark)))
    table = features.dictionary_table(spark, df)
    assert table.filter("comment is null").isEmpty() and table.count() == len(df.columns)
    with pytest.raises(ContractError):
        features.document(df.withColumn("mystery", F.lit(1)))


def test_a_changed_window_changes_column_and_entry(spark):
    for months in (3, 5):
        own = replace(PanelParams(), label_horizon_months=months, momentum_lags=(months,), target_outlier_threshold=months / 10)
        df = features.document(features.build_features(make_panel(spark), own), own)
        entry = {r.column_name: (r.comment, r.formula) for r in features.dictionary_table(spark, df).collect()}
        assert f"price_mom_{months}m" in df.columns and "price_mom_12m" not in df.columns
        assert entry[f"zhvi_mom_{months}m"][1] == f"zhvi[t] / zhvi[t-{months}] - 1"
        assert str(months) in entry["target"][0] and entry["target"][1].startswith(f"median_sale_price[t+{months}]")
        assert str(months / 10) in entry["target_outlier"][1]


@pytest.fixture(scope="module")
def table(spark):
    return split.assign_split(features.build_features(make_panel(spark, months=60))).cache()


def test_split_is_the_last_labelled_months(table):
    got = {r.split: (r.a, r.b) for r in table.groupBy("split").agg(
        F.min("month").alias("a"), F.max("month").alias("b")).collect()}
    assert got == {"train": (month(0), month(50)), "test": (month(51), month(56)),
                   "live": (month(57), month(59))}


def test_too_few_months_raise(spark):
    df = features.build_features(make_panel(spark, months=8))
    with pytest.raises(ContractError):
        split.assign_split(df, PanelParams(holdout_months=6))
    with pytest.raises(ContractError):
        split.assign_split(df.withColumn("target", F.lit(None).cast("double")))


def test_holdout_gap(spark):
    df = split.assign_split(
        features.build_features(make_panel(spark, months=40)), PanelParams(holdout_gap=3))
    assert df.filter("split = 'gap'").select("month").distinct().count() == 3


def test_folds_are_gapped_and_capped(table):
    folds = split.rolling_folds(table, PanelParams(), 5)
    assert [f.val_month for f in folds] == [month(i) for i in range(46, 51)]
    for f in folds:
        assert split.shift_month(f.train_end, 3) == f.val_month
        assert split.shift_month(f.train_start, 35) == f.train_end
    split.require_filled_folds(table, folds)
    rows = split.assign_folds(table, folds)
    assert rows.filter("split <> 'train'").isEmpty()
    # A row is never both train and validation of one fold.
    both = rows.filter("role = 'train'").select("fold", "zip", "month").intersect(
        rows.filter("role = 'val'").select("fold", "zip", "month"))
    assert both.isEmpty()
    sizes = {r.fold: (r.n_train, r.n_val) for r in split.fold_sizes(table, folds).collect()}
    assert sizes[5] == (72, 2)
    with pytest.raises(ContractError):
        split.rolling_folds(table, PanelParams(), 90)


def test_fold_assignment_needs_no_shuffle_and_no_join(table):
    folds = split.rolling_folds(table, PanelParams(), 5)
    plan = split.assign_folds(table, folds)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("InMemoryRelation")[0]
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_rolling_window_and_flags(table):
    recent = split.rolling_window(table, 36)
    assert recent.select("month").distinct().count() == 36
    assert recent.agg(F.max("month")).first()[0] == month(56)
    flagged = table.withColumn("low_volume", F.when(F.col("zip") == "00000", F.lit(True)))
    kept = split.drop_flagged(flagged, ["low_volume", "absent"])
    assert {r.zip for r in kept.select("zip").distinct().collect()} == {"00001"}


def test_join_contracts(spark):
    left = make_panel(spark, months=3).select("zip", "month", "median_sale_price")
    right = make_panel(spark, zips=1, months=3).select("zip", "month", "zhvi")
    assert panel.join_one_to_one(left, right).count() == 3
    with pytest.raises(ContractError):
        panel.join_one_to_one(left, right.union(right))
    assert panel.require_coverage(left, right, 0.5).rate == 0.5
    with pytest.raises(ContractError):
        panel.require_coverage(left, right, 0.6)
    monthly = left.select("month").distinct().withColumn("x", F.lit(1.0))
    assert panel.join_months(left, monthly).count() == 6
    with pytest.raises(ContractError):
        panel.join_months(left, monthly.union(monthly))


def test_macro_range_check_is_per_series(spark):
    df = make_panel(spark, zips=1, months=4).select("zip", "month", "UNRATE", "HOUST")
    late = F.col("month") >= F.lit(month(3))
    macro = df.select("month", F.when(~late, F.col("UNRATE")).alias("UNRATE"), "HOUST")
    joined = df.select("zip", "month").join(macro, "month")
    contracts.require_macro_complete(joined, macro, ["UNRATE", "HOUST"])
    hole = joined.withColumn("HOUST", F.when(F.col("month") != F.lit(month(1)), F.col("HOUST")))
    with pytest.raises(ContractError):
        contracts.require_macro_complete(hole, macro, ["UNRATE", "HOUST"])


def test_schema_contracts(spark):
    match = contracts.match_header(
        ["region_zip", "price", "absent"], ["REGION", "Price"], {"region_zip": ["region"]})
    assert match == ({"region_zip": "REGION", "price": "Price"}, ["absent"], {})
    match = contracts.match_header(["a b", "c"], ["C", "A_B", "AB", "c"], {"c": ["ab"]})
    assert match == ({"a b": "A_B", "c": "c"}, [], {"a b": ["A_B", "AB"]})
    with pytest.raises(ContractError, match="several columns"):
        contracts.require_unambiguous(match, "t")
    df = spark.createDataFrame([(1, "2024-01-01", "NA", "", "7")], "a int, b string, c string, d string, e string")
    with pytest.raises(ContractError):
        contracts.require_columns(df, ["a", "z"], "t")
    assert contracts.discover_wide(["x", "RegionID", "2024-01-31"]) == ("RegionID", ["2024-01-31"])
    with pytest.raises(ContractError):
        contracts.discover_wide(["RegionName", "State"])
    labels = {r.column_name: r.type_label for r in contracts.column_types(df).collect()}
    assert labels == {"a": "int", "b": "date", "c": "str", "d": "null", "e": "int"}
