"""Decision layer: scenario, ranking, eligibility, allocation and their views."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import Controls, ModelParams, band_columns
from panelkit.errors import ContractError, PanelError
from panelkit.functions.numbers import clamp, finite, non_negative
from panelkit.functions.text import money
from panelkit.operators.ordering import position
from panelkit.staging import stage

UNKNOWN = "Unknown"
CONCENTRATION_WARNING = 25.0

# A shift of a level moves its 3-month change by the same amount.
LINKED_DELTAS = {"MORTGAGE30US": "mortgage_delta_3m", "UNRATE": "unrate_delta_3m"}


# --- snapshot and universe ------------------------------------------------------


def latest_snapshot(features: DataFrame) -> DataFrame:
    """Rows of the most recent month (a scalar subquery, then a pushed filter)."""
    latest = features.agg(F.max("month"))
    return features.filter(F.col("month") == latest.scalar())


def subset_universe(
    features: DataFrame, lookup: DataFrame, metros: Sequence[str] = ()
) -> DataFrame:
    """Rows whose zip lies in the chosen metros; no choice keeps everything."""
    if not metros:
        return features
    chosen = lookup.filter(F.col("metro").isin(list(metros))).select("zip")
    return features.join(chosen, "zip", "left_semi")


def attach_metro(df: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Left join of the metro label; unmatched rows are labelled, not dropped."""
    if lookup is None:
        return df.withColumn("metro", F.lit(UNKNOWN))
    joined = df.join(lookup.select("zip", "metro"), "zip", "left")
    return joined.withColumn("metro", F.coalesce("metro", F.lit(UNKNOWN)))


def metro_options(lookup: DataFrame) -> DataFrame:
    return lookup.select("metro").dropna().distinct().orderBy("metro")


def universe_summary(features: DataFrame, lookup: DataFrame) -> DataFrame:
    """One row: rows, zips, latest month, metros, rows with and without a metro."""
    # Counts per zip first, so the join and the totals see one row per zip.
    per_zip = features.groupBy("zip").agg(
        F.count(F.lit(1)).alias("n"), F.max("month").alias("latest")
    )
    known = lookup.groupBy("zip").agg(F.lit(True).alias("known"))
    totals = per_zip.join(known, "zip", "left").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("zips"),
        F.max("latest").alias("as_of"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("metro_matched"),
    )
    metros = lookup.agg(F.countDistinct("metro"))
    return totals.select(
        "rows",
        "zips",
        "as_of",
        metros.scalar().alias("metros"),
        "metro_matched",
        (F.col("rows") - F.col("metro_matched")).alias("metro_unmatched"),
    )


# --- scenarios ------------------------------------------------------------------


def scenario_shift(controls: Controls, params: ModelParams = ModelParams()) -> dict[str, float]:
    """Basis points to points of the rate column; 0 bps is no shift at all."""
    return {params.rate_feature: controls.rate_bps / 100.0} if controls.rate_bps else {}


def risk_lambda(controls: Controls, params: ModelParams = ModelParams()) -> float:
    if controls.risk_tolerance not in params.risk_tolerance:
        raise PanelError(
            f"unknown risk tolerance {controls.risk_tolerance!r}; "
            f"expected one of {sorted(params.risk_tolerance)}"
        )
    return float(params.risk_tolerance[controls.risk_tolerance])


def _check_scenario(columns: Sequence[str], name: str, params: ModelParams) -> None:
    if name not in params.scenario_features:
        raise ContractError(
            f"{name!r} cannot be shifted; allowed: {sorted(params.scenario_features)}"
        )
    if name not in columns:
        raise ContractError(f"scenario column {name!r} is not in the feature table")


def apply_scenario(
    features: DataFrame, shifts: Mapping[str, float], params: ModelParams = ModelParams()
) -> DataFrame:
    """Add a shift to allowed macro columns and to their linked 3-month change."""
    totals: dict[str, float] = {}
    for name, shift in shifts.items():
        _check_scenario(features.columns, name, params)
        for c in (name, LINKED_DELTAS.get(name)):
            if c in features.columns:
                totals[c] = totals.get(c, 0.0) + float(shift)
    return features.withColumns({c: F.col(c) + F.lit(s) for c, s in totals.items()})


def require_reach(features: DataFrame, shifts: Mapping[str, float]) -> None:
    """A shift of a column without any value would change nothing: say so."""
    for name in shifts:
        if name in features.columns and features.filter(F.col(name).isNotNull()).isEmpty():
            raise ContractError(f"no row has {name!r}, so a shift of it moves nothing")


def scenario_grid(
    features: DataFrame, bps: Sequence[int], params: ModelParams = ModelParams()
) -> DataFrame:
    """Every row under every rate shock, tagged ``scenario_bps``: one job for all.

    The shocks are an array literal that is exploded, so rows multiply in place
    without a join.
    """
    name = params.rate_feature
    _check_scenario(features.columns, name, params)
    shocked = features.select("*", F.explode(F.array(*[F.lit(int(b)) for b in bps])).alias("scenario_bps"))
    points = F.col("scenario_bps") / F.lit(100.0)
    moved = [c for c in (name, LINKED_DELTAS.get(name)) if c in features.columns]
    return shocked.withColumns({c: F.col(c) + points for c in moved})


# --- ranking and eligibility ----------------------------------------------------


def add_score(predictions: DataFrame, lam: float) -> DataFrame:
    """Risk-adjusted score: p50 less lambda times the 80 % band, always that band."""
    missing = [c for c in ("p50", "ci80_width") if c not in predictions.columns]
    if missing:
        raise ContractError(f"predictions lack {missing}: score the features first")
    return predictions.withColumn(
        "score", finite(F.col("p50") - F.lit(float(lam)) * F.col("ci80_width"))
    )


def ranking_order() -> list[F.Column]:
    return [F.desc_nulls_last("score"), F.desc_nulls_last("p50"), F.asc("zip")]


def rank(
    predictions: DataFrame,
    lam: float,
    by: Sequence[str] = (),
    max_group: int | None = None,
) -> DataFrame:
    """Score and dense rank over the whole universe, before any filter."""
    return position(add_score(predictions, lam), ranking_order(), by, "rank", max_group)


def eligible(
    ranked: DataFrame,
    min_roi: float,
    max_downside: float,
    ci_level: int,
    exclusions: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """Rows that clear the return and downside bars and are not excluded.

    An exclusion DataFrame (column ``zip``) may be of any size; a short list of
    keys becomes a plain filter.
    """
    low, _ = band_columns(ci_level)
    if low not in ranked.columns:
        raise ContractError(f"ranked table lacks the lower bound {low!r}")
    kept = ranked.filter((F.col("p50") >= min_roi) & (F.col(low) >= -max_downside))
    if isinstance(exclusions, DataFrame):
        return kept.join(exclusions.select("zip").distinct(), "zip", "left_anti")
    if exclusions:
        return kept.filter(~F.col("zip").isin(list(exclusions)))
    return kept


def allocate(qualifying: DataFrame, budget: float) -> DataFrame:
    """Split the budget by non-negative score; equal shares if none is positive.

    The totals are a one-row scalar subquery, so no row is gathered anywhere.
    """
    totals = qualifying.agg(
        F.struct(
            F.coalesce(F.sum(non_negative("score")), F.lit(0.0)).alias("total"),
            F.count(F.lit(1)).alias("n"),
        )
    ).scalar()
    by_score = F.try_divide(non_negative("score"), totals["total"])
    weight = F.when(totals["total"] > 0, by_score).otherwise(F.try_divide(F.lit(1.0), totals["n"]))
    return qualifying.withColumn("weight", weight).withColumn(
        "allocation", F.col("weight") * F.lit(float(budget))
    )


# --- the decision ---------------------------------------------------------------


class Decision(NamedTuple):
    """Lazy frames of one control state: all ranked rows, qualifiers, totals."""

    ranked: DataFrame
    qualifying: DataFrame
    summary: DataFrame


def decide(
    controls: Controls,
    features: DataFrame,
    lookup: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    params: ModelParams = ModelParams(),
    exclusions: DataFrame | None = None,
    max_group: int | None = None,
) -> Decision:
    """Universe, scenario, score, rank, filter, allocate.

    The universe is cut before scoring and the rank is given before filtering.
    The scored rows are written once; everything after reads that table. Keys to
    leave out come as a DataFrame or, if few, with the controls.
    """
    universe = subset_universe(features, lookup, controls.metros)
    shifts = scenario_shift(controls, params)
    require_reach(universe, shifts)
    shifted = apply_scenario(universe, shifts, params)
    scored = stage(attach_metro(scorer(shifted), lookup), "scored")
    ranked = rank(scored, risk_lambda(controls, params), max_group=max_group)
    left_out = controls.exclude_zips if exclusions is None else exclusions
    kept = eligible(
        ranked, controls.min_roi, controls.max_downside, controls.ci_level, left_out
    )
    qualifying = allocate(kept, controls.budget)
    return Decision(ranked, qualifying, decision_summary(ranked, qualifying, controls.budget))


def decision_summary(ranked: DataFrame, qualifying: DataFrame, budget: float) -> DataFrame:
    """One row: evaluated, qualified, budget, deployed, unallocated."""
    evaluated = ranked.agg(F.count(F.lit(1)))
    return qualifying.agg(
        F.count(F.lit(1)).alias("qualified"),
        F.coalesce(F.sum("allocation"), F.lit(0.0)).alias("deployed"),
    ).select(
        evaluated.scalar().alias("evaluated"),
        "qualified",
        F.lit(float(budget)).alias("budget"),
        "deployed",
        F.greatest(F.lit(0.0), F.lit(float(budget)) - F.col("deployed")).alias("unallocated"),
    )


# --- views over a decision ------------------------------------------------------


def display_table(qualifying: DataFrame, ci_level: int) -> DataFrame:
    """Qualifying rows in display units: percent, percentage points, dollars."""
    low, high = band_columns(ci_level)
    return qualifying.select(
        "rank",
        "zip",
        "metro",
        (F.col("p50") * 100).alias("pred_pct"),
        (F.col(low) * 100).alias("ci_lo_pct"),
        (F.col(high) * 100).alias("ci_hi_pct"),
        (F.col("score") * 100).alias("score_pp"),
        F.coalesce("allocation", F.lit(0.0)).alias("allocation"),
        (F.coalesce("weight", F.lit(0.0)) * 100).alias("share_pct"),
    )


def export_names(ci_level: int) -> dict[str, str]:
    """Display column -> export header with its unit."""
    return {
        "pred_pct": "predicted_3mo_change_pct",
        "ci_lo_pct": f"ci{ci_level}_low_pct",
        "ci_hi_pct": f"ci{ci_level}_high_pct",
        "score_pp": "risk_adjusted_score_pp",
        "allocation": "allocated_usd",
        "share_pct": "allocated_share_pct",
    }


def concentration(display: DataFrame) -> DataFrame:
    """One row: largest share, funded rows, rows, and whether to warn."""
    return display.agg(
        F.max("share_pct").alias("top_share_pct"),
        F.count_if(F.col("allocation") > 0).alias("funded"),
        F.count(F.lit(1)).alias("qualified"),
    ).withColumn(
        "concentrated",
        F.coalesce(F.col("top_share_pct") >= CONCENTRATION_WARNING, F.lit(False)),
    )


def concentration_note(summary: DataFrame) -> DataFrame:
    """The warning as text, NULL where there is nothing to warn about."""
    text = F.format_string(
        "Concentrated: %.1f%% of the budget goes to one zip; %,d of %,d qualifying zips get a share.",
        "top_share_pct",
        "funded",
        "qualified",
    )
    return summary.withColumn("note", F.when(F.col("concentrated"), text))


def top_allocations(display: DataFrame, n: int = 20) -> DataFrame:
    """The n largest allocations, smallest of them first."""
    biggest = display.orderBy(F.desc("allocation"), F.asc("zip")).limit(n)
    return biggest.orderBy(F.asc("allocation"), F.desc("zip"))


def map_frame(
    ranked: DataFrame,
    qualifying: DataFrame,
    metros: Sequence[str] = (),
    params: ModelParams = ModelParams(),
) -> DataFrame:
    """Every evaluated row with its allocation; the others keep a NULL one."""
    given = qualifying.select("zip", "allocation", F.lit(True).alias("_in"))
    low, high = params.color_domain
    rows = ranked.select("zip", "metro", "rank", "p50", "p05", "p10", "p90", "p95")
    if metros:
        rows = rows.filter(F.col("metro").isin(list(metros)))
    return rows.join(given, "zip", "left").select(
        *rows.columns,
        F.coalesce("_in", F.lit(False)).alias("qualifies"),
        "allocation",
        clamp("p50", low, high).alias("color_value"),
        money("allocation").alias("allocation_text"),
    )


def entity_cards(ranked: DataFrame, qualifying: DataFrame, ci_level: int) -> DataFrame:
    """Rank, forecast, band and allocation (NULL if none) of every zip."""
    low, high = band_columns(ci_level)
    cards = ranked.select(
        "zip",
        "rank",
        (F.col("p50") * 100).alias("pred_pct"),
        (F.col(low) * 100).alias("ci_lo_pct"),
        (F.col(high) * 100).alias("ci_hi_pct"),
    )
    return cards.join(qualifying.select("zip", "allocation"), "zip", "left")

