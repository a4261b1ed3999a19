"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

WHITE = "[\\x20\\x09-\\x0D]+"  # the white space every word split of this package uses
KEY = ("_key_a", "_key_b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a whole text; NULL has none. One plain separator splits faster than a pattern."""
    spaced = F.coalesce(text, F.lit(""))
    for white in "\t\n\x0b\f\r":
        spaced = F.replace(spaced, F.lit(white), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def row_key(prefix: str = "") -> list[Column]:
    """Two hashes that name (doc_id, text), so that rows can be found again.

    Rows with the same id and text share the key; NULL differs from empty.
    """
    doc_id, text = F.col(f"{prefix}doc_id"), F.col(f"{prefix}text")
    parts = [doc_id, text, doc_id.isNull(), text.isNull()]
    return [F.xxhash64(*parts).alias(KEY[0]), F.hash(*parts).alias(KEY[1])]


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row key, whatever other columns there are."""
    return docs.select("doc_id", "text", *row_key())


def whole_rows(docs: DataFrame) -> DataFrame:
    """All columns as one struct, so that no name can clash with those of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is in ``kept``, one per key, with the columns of ``docs``.

    Both steps hash on the key, so the texts are shuffled once.
    """
    keyed = whole_rows(docs).select("whole", *row_key("whole."))
    found = keyed.join(kept.select(*KEY), list(KEY), "left_semi")
    return found.dropDuplicates(list(KEY)).select("whole.*")


def runs_for(rows: int) -> int:
    """Runs for ``numbered`` that hold about 50,000 rows each, within what may be broadcast."""
    return max(1024, min(1 << 15, rows // 50_000))


def numbered(df: DataFrame, by: str, order: list[str], name: str, runs: int = 1024) -> DataFrame:
    """Gapless position from 0 within each value of ``by``, without one task per value.

    Rows fall into ``runs`` runs by a hash of ``order``; a row's position is the size of
    the earlier runs plus its rank inside its own run. ``by`` must have few values: the
    table of run sizes has at most (values x runs) rows and is broadcast by that bound.
    """
    placed = df.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(runs)).cast("int"))
    earlier = Window.partitionBy(by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(by, "_run").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(by, "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(by, "_run").orderBy(*order)
    ranked = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = ranked.join(F.broadcast(offsets), [by, "_run"])
    return joined.withColumn(name, F.col("_before") + F.col("_rank")).drop("_run", "_before", "_rank")


def span_type() -> T.DataType:
    """Half-open code point range with the kind of what was found there."""
    return T.ArrayType(
        T.StructType(
            [
                T.StructField("kind", T.StringType()),
                T.StructField("start", T.LongType()),
                T.StructField("end", T.LongType()),
            ]
        )
    )
