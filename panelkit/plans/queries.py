"""Registered queries on the test tables: name -> callable(spark, folder).

Every query runs over the whole tables. Doubles are rounded to six places at
the very end, because the order of a distributed sum is not fixed; the nudge
sends values that end exactly half way in one direction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import Controls, ModelParams
from panelkit.operators import (
    contracts,
    decide,
    explain,
    features,
    geo,
    metrics,
    models,
    monitor,
    panel,
    profile,
    split,
    tidy,
)
from panelkit.operators.models import monotone_quantiles
from panelkit.operators.quantiles import grouped_percentiles
from panelkit.plans.build import (
    bound_features,
    bound_lookup,
    bound_panel,
    macro_months,
    tidy_cells,
    written_once,
)
from panelkit.sources import bind, lists
from panelkit.staging import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PARAMS = bind.PARAMS
MODEL = ModelParams()
SERIES = list(PARAMS.macro_series)
CONTROLS = Controls(max_downside=0.05, budget=1_000_000.0)
CUTOFF = "1999-06-01"
CHOSEN_METROS = tuple(f"NATION_{k}" for k in range(0, 25, 2))

# A fixed linear scorer, so that attributions can be checked by SQL.
STUB_WEIGHTS = {
    "price_mom_3m": -0.25,
    "price_mom_12m": -0.10,
    "zhvi_mom_3m": 0.05,
    "listings_to_sales": 0.04,
    "homes_sold": 0.002,
    "month_of_year": 0.001,
    "UNRATE": -0.003,
}


NUDGE = 1e-9


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(n) + F.lit(NUDGE), 6).alias(n) if t == "double" else F.col(n)
            for n, t in df.dtypes
        ]
    )


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, folder: rounded(fn(spark, folder))
    return fn


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return decide.latest_snapshot(bound_features(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Stub predictions of the latest month with their metro, written once per input state."""

    def build(session: SparkSession, path: str) -> DataFrame:
        rows = bind.stub_predictions(snapshot(session, path))
        return decide.attach_metro(rows, bound_lookup(session, path))

    return written_once(spark, folder, "scored", build)


def decided(spark: SparkSession, folder: str, **changes) -> decide.Decision:
    controls = Controls(**{**CONTROLS.__dict__, **changes})
    exclusions = lists.clean_keys(bind.exclusion_values(spark, folder))
    ranked = decide.rank(
        scored(spark, folder), decide.risk_lambda(controls, MODEL)
    )
    kept = decide.eligible(
        ranked, controls.min_roi, controls.max_downside, controls.ci_level, exclusions
    )
    qualifying = decide.allocate(kept, controls.budget)
    return decide.Decision(
        ranked, qualifying, decide.decision_summary(ranked, qualifying, controls.budget)
    )


def unflagged(df: DataFrame) -> DataFrame:
    return split.drop_flagged(df, MODEL.exclude_flags)


def fold_rows(spark: SparkSession, folder: str) -> DataFrame:
    table = bound_features(spark, folder)
    folds = split.rolling_folds(table, PARAMS, MODEL.folds)
    return unflagged(split.assign_folds(table, folds))


NAIVE = {"naive_zero": models.predict_zero, "naive_momentum": models.predict_momentum}


def naive_cv(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    table = bound_features(spark, folder)
    chosen = {n: NAIVE[n] for n in names}
    return models.cross_validate(table, features.feature_columns(table), chosen, PARAMS, MODEL)


def naive_holdout(spark: SparkSession, folder: str) -> DataFrame:
    table = bound_features(spark, folder)
    return models.holdout(table, features.feature_columns(table), NAIVE, MODEL)


# --- sources and tidy tables ----------------------------------------------------


@query
def tracker_funnel(spark, folder):
    return tidy.tracker_funnel(bind.tracker(spark, folder), PARAMS)


@query
def tracker_dedup_latest(spark, folder):
    cells = stage(tidy_cells(spark, folder), "tidy")
    return tidy.drop_empty_columns(cells, ["price_drops", "inventory"])


@query
def duplicate_cells(spark, folder):
    raw = tidy.select_rows(bind.tracker(spark, folder, PARAMS.property_type), PARAMS)
    return contracts.duplicate_keys(raw, ["region_zip", "period_begin", "period_end"])


@query
def wide_index_unpivot(spark, folder):
    return tidy.tidy_wide(bind.index_wide(spark, folder))


@query
def macro_monthly_pivot(spark, folder):
    return macro_months(spark, folder, fill=False)


@query
def macro_gap_fill(spark, folder):
    return macro_months(spark, folder)


@query
def macro_calendar_fill(spark, folder):
    """A month in which no series published anything, filled on request."""
    known = bind.macro_observations(spark, folder).filter(F.trunc("date", "month") != F.lit("1998-02-01").cast("date"))
    return tidy.tidy_macro(known, PARAMS.macro_series, spine=True)


@query
def key_metro_mode(spark, folder):
    return bound_lookup(spark, folder)


@query
def metro_options(spark, folder):
    return decide.metro_options(bound_lookup(spark, folder))


@query
def category_counts(spark, folder):
    return profile.category_counts(bound_features(spark, folder), "split")


@query
def column_types(spark, folder):
    return contracts.column_types(stage(tidy_cells(spark, folder), "tidy"))


# --- panel, features, splits ----------------------------------------------------


@query
def panel_join(spark, folder):
    return bound_panel(spark, folder)


@query
def panel_coverage(spark, folder):
    cells = tidy_cells(spark, folder)
    return panel.match_coverage(cells, bind.index(spark, folder))


@query
def macro_range_check(spark, folder):
    rows = bound_panel(spark, folder)
    return contracts.macro_gaps(rows, macro_months(spark, folder), SERIES)


@query
def features_momentum(spark, folder):
    made = features.build_features(bound_panel(spark, folder), PARAMS)
    lags = [f"{p}_mom_{k}m" for p in ("price", "zhvi") for k in PARAMS.momentum_lags]
    return made.select(
        "zip",
        "month",
        *lags,
        "listings_to_sales",
        "inventory_chg_3m",
        "mortgage_delta_3m",
        "unrate_delta_3m",
        "month_of_year",
    )


@query
def label_3m(spark, folder):
    made = features.build_features(bound_panel(spark, folder), PARAMS)
    return made.select("zip", "month", "median_sale_price", "target", "target_outlier")


@query
def momentum_leaders(spark, folder):
    made = features.build_features(bound_panel(spark, folder), PARAMS)
    kept = made.filter(F.col("price_mom_3m").isNotNull() & ~F.col("low_volume"))
    return (
        kept.select("zip", "month", "median_sale_price", "price_mom_3m")
        .orderBy(F.desc("price_mom_3m"), "zip", "month")
        .limit(25)
    )


@query
def lookahead_audit(spark, folder):
    """Corrupt every month after the cutoff; no feature up to it may move."""
    rows = stage(bound_panel(spark, folder), "panel")
    late = F.col("month") > F.lit(CUTOFF).cast("date")
    spoiled = rows.withColumns(
        {
            c: F.when(late, F.col(c) * 10 + 1).otherwise(F.col(c))
            for c in ("median_sale_price", "inventory", "homes_sold", "zhvi", *SERIES)
        }
    )
    cutoff = F.lit(CUTOFF).cast("date")
    original = features.build_features(rows, PARAMS)
    changed = features.lookahead_differences(
        original, features.build_features(spoiled, PARAMS), cutoff
    )
    return changed.agg(F.count(F.lit(1)).alias("differing_rows")).select(
        "differing_rows",
        rows.filter(F.col("month") <= cutoff)
        .agg(F.count(F.lit(1)))
        .scalar()
        .alias("compared_rows"),
    )


@query
def split_assign(spark, folder):
    return bound_features(spark, folder).select("zip", "month", "target", "split")


@query
def rolling_folds(spark, folder):
    table = bound_features(spark, folder)
    folds = split.rolling_folds(table, PARAMS, MODEL.folds)
    ranges = split.fold_table(spark, folds)
    return ranges.join(split.fold_sizes(table, folds), ["fold", "val_month"], "left")


@query
def rolling_window_36(spark, folder):
    recent = split.rolling_window(bound_features(spark, folder), PARAMS.train_window_months)
    return recent.select("zip", "month", "target")


@query
def entity_history(spark, folder):
    """Every entity's span, length and latest state, in one pass."""
    table = bound_features(spark, folder)
    return table.groupBy("zip").agg(
        F.count(F.lit(1)).alias("months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.max_by("median_sale_price", "month").alias("last_price"),
        F.max_by("split", "month").alias("last_split"),
    )


# --- metrics --------------------------------------------------------------------


@query
def baseline_zero_cv(spark, folder):
    return naive_cv(spark, folder, "naive_zero").drop("model")


@query
def baseline_momentum_cv(spark, folder):
    return naive_cv(spark, folder, "naive_momentum").drop("model")


@query
def baseline_comparison(spark, folder):
    report = naive_cv(spark, folder, *NAIVE)
    return metrics.mark_best(report.filter(F.col("month").isNull()).drop("month"))


@query
def holdout_baselines(spark, folder):
    return naive_holdout(spark, folder)


@query
def holdout_headline(spark, folder):
    pooled = naive_holdout(spark, folder).filter(F.col("month").isNull())
    return metrics.headline_delta(pooled, "naive_momentum", "naive_zero", "mae")


def _metro_bands(spark, folder) -> DataFrame:
    """Validation rows with the target percentiles of their fold and metro."""
    rows = fold_rows(spark, folder).select("zip", "month", "fold", "role", "target")
    placed = stage(decide.attach_metro(rows, bound_lookup(spark, folder)), "fold_rows")
    named = {f"p{round(q * 100):02d}": ("target", q) for q in MODEL.quantiles}
    bands = grouped_percentiles(
        placed.filter(F.col("role") == "train"), ["fold", "metro"], named
    )
    held = placed.filter(F.col("role") == "val")
    return held.join(bands, ["fold", "metro"])


@query
def interval_coverage(spark, folder):
    return metrics.interval_coverage(_metro_bands(spark, folder))


@query
def calibration_table(spark, folder):
    return metrics.calibration_table(metrics.interval_coverage(_metro_bands(spark, folder)))


@query
def drift_topn(spark, folder):
    table = bound_features(spark, folder)
    window = unflagged(split.rolling_window(table, PARAMS.train_window_months))
    reference = table.filter(F.col("split") == "train")
    return metrics.drift_stats(window, reference, features.feature_columns(table))


@query
def degradation_gate(spark, folder):
    """Momentum forecast of the latest labelled month against its pooled CV error."""
    table = bound_features(spark, folder)
    folds = split.rolling_folds(table, PARAMS, MODEL.folds)
    error = F.pow(F.coalesce("price_mom_3m", F.lit(0.0)) - F.col("target"), F.lit(2.0))
    held = unflagged(split.assign_folds(table, folds)).filter(F.col("role") == "val")
    baseline = held.agg(F.sqrt(F.avg(error))).scalar()
    recent = unflagged(split.labelled(table))
    latest = decide.latest_snapshot(recent)
    fresh = latest.agg(F.sqrt(F.avg(error)).alias("fresh_rmse")).withColumn(
        "baseline_rmse", baseline
    )
    return monitor.degradation_gate(fresh, MODEL.degradation_multiplier)


# --- profiles -------------------------------------------------------------------


@query
def missing_profile(spark, folder):
    return profile.missing_profile(bound_features(spark, folder))


@query
def quality_summary(spark, folder):
    table = bound_features(spark, folder)
    return profile.quality_summary(table, tidy_cells(spark, folder))


@query
def universe_summary(spark, folder):
    return decide.universe_summary(bound_features(spark, folder), bound_lookup(spark, folder))


@query
def value_percentiles(spark, folder):
    orders = bind.table(spark, folder, "orders")
    return profile.value_percentiles(orders, ["o_orderpriority"], "o_totalprice", (0.5, 0.95))


# --- decisions on deterministic predictions -------------------------------------


@query
def latest_snapshot(spark, folder):
    return bind.stub_predictions(snapshot(spark, folder)).select(
        "zip", "month", "point", "p05", "p10", "p50", "p90", "p95", "ci80_width", "ci90_width"
    )


@query
def scenario_apply(spark, folder):
    """Rows without a published rate stay as they are."""
    table = bound_features(spark, folder)
    shifted = decide.apply_scenario(table, {"MORTGAGE30US": 0.5, "mortgage_delta_3m": 0.25})
    return shifted.select("zip", "month", "MORTGAGE30US", "mortgage_delta_3m", "UNRATE")


@query
def scenario_grid(spark, folder):
    """All rate shocks on the last month with a published rate, ranked per shock."""
    table = bound_features(spark, folder)
    latest = decide.latest_snapshot(table.filter(F.col("mortgage_delta_3m").isNotNull()))
    shocked = decide.scenario_grid(latest, MODEL.rate_scenarios_bps)
    ranked = decide.rank(
        stage(bind.stub_predictions(shocked), "scored"), 0.25, by=["scenario_bps"]
    )
    return ranked.select("scenario_bps", "rank", "zip", "p50", "score")


@query
def rank_corr_with_missing(spark, folder):
    """Rank correlation per month of two columns that both have gaps."""
    pairs = bound_features(spark, folder).select("month", "target", F.col("price_mom_12m").alias("prediction"))
    return metrics.rank_correlation(stage(pairs, "pairs"), ["month"])


@query
def decide_full(spark, folder):
    """The whole decision: metros, rate shock, exclusions, budget; last month with a rate."""
    table = bound_features(spark, folder)
    rated = decide.latest_snapshot(table.filter(F.col("mortgage_delta_3m").isNotNull()))
    controls = Controls(metros=CHOSEN_METROS, rate_bps=50, max_downside=0.05, budget=250_000.0)
    exclusions = lists.clean_keys(bind.exclusion_values(spark, folder))
    made = decide.decide(
        controls, rated, bound_lookup(spark, folder), bind.stub_predictions, MODEL, exclusions
    )
    given = made.qualifying.select("zip", "weight", "allocation")
    return made.ranked.select(*RANKED).join(given, "zip", "left")


@query
def rate_shock_moves(spark, folder):
    """Rows of each rate shock, how many a shock reaches and how many change place."""
    table = bound_features(spark, folder)
    rated = decide.latest_snapshot(table.filter(F.col("mortgage_delta_3m").isNotNull()))
    shocked = bind.stub_predictions(decide.scenario_grid(rated, MODEL.rate_scenarios_bps))
    base = bind.stub_predictions(rated).select("zip", F.col("p50").alias("base"))
    return shocked.join(base, "zip").groupBy("scenario_bps").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.abs(F.col("p50") - F.col("base")) > 1e-9).alias("moved"),
    )


RANKED = ["rank", "zip", "metro", "p50", "p05", "p10", "p90", "p95", "ci80_width", "score"]


@query
def rank_universe(spark, folder):
    return decide.rank(scored(spark, folder), 0.25).select(*RANKED)


@query
def eligible_80(spark, folder):
    return decided(spark, folder, ci_level=80).qualifying.select(*RANKED)


@query
def eligible_90(spark, folder):
    return decided(spark, folder, ci_level=90, max_downside=0.03).qualifying.select(*RANKED)


@query
def allocate_budget(spark, folder):
    return decided(spark, folder).qualifying.select("zip", "score", "weight", "allocation")


@query
def allocate_equal_split(spark, folder):
    """A lambda so large that no score is positive: equal shares."""
    kept = decide.eligible(decide.add_score(scored(spark, folder), 1000.0), 0.0, 0.05, 80)
    return decide.allocate(kept, 500_000.0).select("zip", "weight", "allocation")


@query
def decision_summary(spark, folder):
    return decided(spark, folder).summary


@query
def decision_none_qualify(spark, folder):
    """Nothing clears the bar: the whole budget stays unallocated."""
    return decided(spark, folder, min_roi=9.0).summary


@query
def display_table(spark, folder):
    return decide.display_table(decided(spark, folder, ci_level=90).qualifying, 90)


@query
def allocation_concentration(spark, folder):
    shown = decide.display_table(decided(spark, folder).qualifying, 80)
    return decide.concentration(shown)


@query
def tolerance_effect(spark, folder):
    """Funded zips and largest share under every tolerance label, in one frame."""
    rows = scored(spark, folder)
    parts = []
    for label, lam in MODEL.risk_tolerance.items():
        kept = decide.eligible(decide.add_score(rows, lam), 0.0, 0.05, 80)
        given = decide.allocate(kept, CONTROLS.budget)
        parts.append(
            given.agg(
                F.lit(label).alias("risk_tolerance"),
                F.count_if(F.col("allocation") > 0).alias("funded"),
                F.max("weight").alias("top_weight"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def top_allocations(spark, folder):
    shown = decide.display_table(decided(spark, folder).qualifying, 80)
    return decide.top_allocations(shown).select("zip", "rank", "allocation", "share_pct")


@query
def entity_card(spark, folder):
    made = decided(spark, folder)
    return decide.entity_cards(made.ranked, made.qualifying, 80)


@query
def map_frame(spark, folder):
    made = decided(spark, folder)
    return decide.map_frame(made.ranked, made.qualifying)


@query
def metro_subset(spark, folder):
    """The metro choice cuts the universe before scoring."""
    lookup = bound_lookup(spark, folder)
    chosen = decide.subset_universe(snapshot(spark, folder), lookup, CHOSEN_METROS)
    rows = stage(decide.attach_metro(bind.stub_predictions(chosen), lookup), "scored")
    return decide.rank(rows, 0.25).select("rank", "zip", "metro", "score")


@query
def backtest_stub(spark, folder):
    """Predicted and realised change of every zip in the holdout months."""
    test = split.labelled(bound_features(spark, folder).filter(F.col("split") == "test"))
    return bind.stub_predictions(test).select(
        "zip",
        "month",
        F.col("p50").alias("predicted"),
        F.col("target").alias("realized"),
        F.col("p10").alias("lo"),
        F.col("p90").alias("hi"),
    )


@query
def quantile_repair(spark, folder):
    """Sort five crossing columns per row, missing ones last, and derive the band widths."""
    rows = bound_features(spark, folder)
    five = ["price_mom_12m", "price_mom_1m", "zhvi_mom_3m", "price_mom_6m", "price_mom_3m"]
    return monotone_quantiles(rows.withColumn("_q", F.array(*five)), "_q", MODEL.quantiles).select(
        "zip", "month", "p05", "p10", "p50", "p90", "p95", "ci80_width", "ci90_width"
    )


# --- explanation on a fixed linear scorer ---------------------------------------


def stub_contributions(spark, folder) -> DataFrame:
    table = bound_features(spark, folder)
    # Seven means: model parameters, not data.
    row = table.filter(F.col("split") == "train").agg(
        *[F.avg(c).alias(c) for c in STUB_WEIGHTS]
    ).first()
    means = {c: row[c] or 0.0 for c in STUB_WEIGHTS}
    return explain.linear_contributions(decide.latest_snapshot(table), STUB_WEIGHTS, means)


@query
def linear_contributions(spark, folder):
    return stub_contributions(spark, folder)


@query
def contribution_top3(spark, folder):
    return explain.top_contributions(stub_contributions(spark, folder), 3)


@query
def contribution_residual(spark, folder):
    return explain.with_residual(stub_contributions(spark, folder), 3)


@query
def driver_sentence(spark, folder):
    return explain.driver_sentences(stub_contributions(spark, folder))


@query
def stub_importance(spark, folder):
    return explain.mean_importance(stub_contributions(spark, folder), 5)


@query
def seeded_sample(spark, folder):
    train = unflagged(bound_features(spark, folder).filter(F.col("split") == "train"))
    return explain.seeded_sample(train, 500, MODEL.seed).select("zip", "month", "target")


@query
def peer_median(spark, folder):
    columns = ["price_mom_3m", "median_sale_price", "homes_sold", "listings_to_sales"]
    return explain.peer_medians(
        snapshot(spark, folder), bound_lookup(spark, folder), columns
    )


# --- key lists and geometry -----------------------------------------------------


@query
def exclusion_keys_clean(spark, folder):
    return lists.clean_keys(bind.exclusion_values(spark, folder))


@query
def exclusion_keys_rejected(spark, folder):
    return lists.rejection_report(bind.exclusion_values(spark, folder))


def _geometry_keys(spark, folder) -> DataFrame:
    return bind.geometries(spark, folder).select(F.col("id").alias("zip"))


@query
def key_coverage(spark, folder):
    return geo.key_coverage(snapshot(spark, folder).select("zip"), _geometry_keys(spark, folder))


@query
def key_unmatched(spark, folder):
    return geo.unmatched_keys(
        snapshot(spark, folder).select("zip"), _geometry_keys(spark, folder)
    )


@query
def bounding_box(spark, folder):
    drawn = geo.subset_geometries(bind.geometries(spark, folder), snapshot(spark, folder))
    return geo.padded_ranges(geo.bounds(drawn))
