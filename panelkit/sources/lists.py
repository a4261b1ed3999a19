"""User-supplied key lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.errors import ListFormatError
from panelkit.functions.keys import is_valid_key, list_key

EXPECTED = "expected a CSV with a `zip` column, or a single column of keys without a header"


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    """Column ``value`` of a CSV with a `zip` header (any case) or one bare column.

    Whether the first line is a header is decided from that line alone. Of a
    bare column every line is a key, the first one included.
    """
    header = spark.read.csv(path, header=True, inferSchema=False)
    if not header.columns:
        raise ListFormatError(f"the file is empty; {EXPECTED}")
    named = {c.strip().lower(): c for c in header.columns}
    if "zip" in named:
        return header.select(F.col(f"`{named['zip']}`").alias("value")).dropna()
    if len(header.columns) > 1:
        raise ListFormatError(f"no `zip` column among {header.columns}; {EXPECTED}")
    return spark.read.csv(path, header=False).toDF("value").dropna()


def clean_keys(values: DataFrame) -> DataFrame:
    """Normalised, well-formed keys; blanks are dropped."""
    keys = values.select(list_key("value").alias("zip")).dropna()
    return keys.filter(is_valid_key("zip"))


def rejected_keys(values: DataFrame) -> DataFrame:
    """Distinct keys that are not five digits."""
    keys = values.select(list_key("value").alias("zip")).dropna()
    return keys.filter(~is_valid_key("zip")).distinct()


def rejection_report(values: DataFrame, shown: int = 5) -> DataFrame:
    """One row: the first few bad keys in order, and how many more there are."""
    bad = rejected_keys(values)
    first = bad.orderBy("zip").limit(shown).agg(F.array_sort(F.collect_list("zip")))
    return bad.agg(F.count(F.lit(1)).alias("n")).select(
        F.array_join(first.scalar(), ", ").alias("shown"),
        F.greatest(F.col("n") - shown, F.lit(0)).alias("more"),
    )


def parse_exclusions(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Keys of an exclusion file, as column ``zip``.

    Strict mode raises on the first malformed key list; otherwise malformed keys
    are left out (see ``rejected_keys``).
    """
    values = read_key_list(spark, path)
    if strict:
        report = rejection_report(values).first()
        if report["shown"]:
            more = f" (and {report['more']} more)" if report["more"] else ""
            raise ListFormatError(f"not five-digit keys: {report['shown']}{more}; {EXPECTED}")
    keys = clean_keys(values)
    if keys.isEmpty():
        raise ListFormatError(f"no keys found in the file; {EXPECTED}")
    return keys
