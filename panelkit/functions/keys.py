"""Entity-key normalisers: every source ends up with the same padded text key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_WIDTH = 5
KEY_PATTERN = "^[0-9]{5}$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _strip(value: Column | str) -> Column:
    return F.regexp_replace(_col(value), r"^\s+|\s+$", "")


def pad_key(text: Column | str) -> Column:
    """Left-pad with zeros; longer keys are kept whole."""
    text = _col(text)
    return F.when(F.length(text) < KEY_WIDTH, F.lpad(text, KEY_WIDTH, "0")).otherwise(text)


def _digits(text: Column | str, pattern: str) -> Column:
    found = F.regexp_extract(_col(text).cast("string"), pattern, 1)
    return pad_key(F.nullif(found, F.lit("")))


def trailing_digits_key(text: Column | str) -> Column:
    """Key of a labelled region such as 'Zip Code: 210'; no digits -> NULL."""
    return _digits(text, r"(\d+)\s*$")


def leading_digits_key(text: Column | str) -> Column:
    """Key of a wide-table region name: its first run of digits."""
    return _digits(text, r"(\d+)")


def geometry_key(text: Column | str) -> Column:
    """Key of a geometry property: stripped and padded, nothing else."""
    return pad_key(F.coalesce(_strip(_col(text).cast("string")), F.lit("")))


def list_key(text: Column | str) -> Column:
    """Key typed by a user: blanks -> NULL, a trailing '.0' is dropped."""
    clean = F.nullif(_strip(text), F.lit(""))
    return pad_key(F.regexp_replace(clean, r"\.0$", ""))


def is_valid_key(key: Column | str) -> Column:
    return _col(key).rlike(KEY_PATTERN)
