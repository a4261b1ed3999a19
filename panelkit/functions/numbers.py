"""Numeric expressions with one rule: missing is NULL, never NaN or infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(text: Column | str) -> Column:
    """Text to double; text that is not a finite number becomes NULL."""
    value = F.col(text) if isinstance(text, str) else text
    return finite(value.try_cast("double"))


def finite(value: Column | str) -> Column:
    """NaN and infinities to NULL."""
    value = F.col(value) if isinstance(value, str) else value
    usable = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(usable, value)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """top / bottom, NULL where the bottom is zero or missing."""
    return F.try_divide(top, bottom)


def pct_change(now: Column | str, base: Column | str) -> Column:
    """now / base - 1 as a fraction."""
    return ratio(now, base) - F.lit(1.0)


def flag(condition: Column) -> Column:
    """A condition as a flag that is never NULL."""
    return F.coalesce(condition, F.lit(False))


def clamp(value: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; missing stays missing."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def non_negative(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value > 0, value).when(value.isNotNull(), F.lit(0.0))


def quantile_label(q: float) -> str:
    """0.05 -> 'p05'."""
    return f"p{round(q * 100):02d}"
