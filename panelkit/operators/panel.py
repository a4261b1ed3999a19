"""Joining the tidy sources into one (zip, month) panel."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import PanelParams
from panelkit.errors import ContractError
from panelkit.operators.contracts import require_unique

KEY = ["zip", "month"]


def join_one_to_one(left: DataFrame, right: DataFrame, validate: bool = True) -> DataFrame:
    """Inner join on (zip, month), unique on both sides."""
    if validate:
        require_unique(left, KEY, "left side")
        require_unique(right, KEY, "right side")
    return left.join(right, KEY, "inner")


def join_months(panel: DataFrame, monthly: DataFrame, validate: bool = True) -> DataFrame:
    """Left join of a table with one row per month.

    A DATE column has fewer than 120,000 month starts, so a table unique on
    month is bounded by its type and safe to broadcast at any panel size.
    """
    if validate:
        require_unique(monthly, ["month"], "monthly table")
    return panel.join(F.broadcast(monthly), "month", "left")


class Coverage(NamedTuple):
    left_rows: int
    matched_rows: int

    @property
    def rate(self) -> float:
        return self.matched_rows / self.left_rows if self.left_rows else 0.0


def match_coverage(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows of ``left``, rows with a partner, and their share."""
    partner = right.select(*KEY, F.lit(True).alias("_hit"))
    return (
        left.select(*KEY)
        .join(partner, KEY, "left")
        .agg(
            F.count(F.lit(1)).alias("left_rows"),
            F.count("_hit").alias("matched_rows"),
        )
        .withColumn(
            "coverage",
            F.coalesce(F.try_divide("matched_rows", "left_rows"), F.lit(0.0)),
        )
    )


def require_coverage(left: DataFrame, right: DataFrame, minimum: float) -> Coverage:
    row = match_coverage(left, right).first()
    found = Coverage(row["left_rows"], row["matched_rows"])
    if found.rate < minimum:
        raise ContractError(
            f"only {found.rate:.1%} of the left rows found a partner (< {minimum:.0%}); "
            "the keys are probably misaligned: check padding and month convention"
        )
    return found


def build_panel(
    tracker: DataFrame,
    index: DataFrame,
    macro: DataFrame,
    params: PanelParams = PanelParams(),
    validate: bool = True,
) -> DataFrame:
    """Tracker x index (inner, one to one) and macro (left, many to one).

    The uniqueness and coverage checks are actions; ``validate=False`` skips
    them for sources whose tidy step already guarantees the key.
    """
    if validate:
        require_coverage(tracker, index, params.join_coverage_min)
    joined = join_one_to_one(tracker, index, validate)
    return join_months(joined, macro, validate)
