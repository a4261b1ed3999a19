"""Exact duplicates by a tree merge of sorted digest runs.

Texts are equal when identical after each run of white space became one space. Every
row falls into one of ``RUNS`` runs by a hash of its row number, so a text held by a
third of all rows is spread over all runs. A run is folded to one row per digest by a
sorted aggregation. In binomial rounds ``FAN`` runs at a time are merged (run number
divided by ``FAN``), until one run is left; that run is spread over all tasks by digest.
Every round keeps the smallest identifier, and rows meet only if SHA-256, UTF-8 length
and a second, independent 64-bit hash all agree. The winners go down the same tree, so
no join ever sees more than ``FAN`` rows per text and run, except the leaf join, which
sees a text only within one run.

Defined results: NULL text is empty. A NULL doc_id is larger than any other; a class of
NULL ids has keep_id NULL. Of repeated rows with the smallest doc_id one stays. An empty
table gives no rows. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import KEY, WHITE, keep_rows, keyed_texts
from panelkit.staging import stage

RUNS, FAN = 256, 16
DIGEST = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digest_rows(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Narrow table of one row per document: number, id, digest. Reads each text once."""
    text = normalised(F.col("text"))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        *carry,
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )


def merge(runs: DataFrame, run: Column) -> DataFrame:
    """One round: runs that get the same number become one, with one row per digest."""
    moved = runs.withColumn("run", run)
    return moved.groupBy("run", *DIGEST).agg(F.min("head").alias("head"), F.sum("n").alias("n"))


def exact_classes(docs: DataFrame, carry: tuple[str, ...] = (), runs: int = RUNS, fan: int = FAN) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and ``carry``."""
    rows = stage(digest_rows(docs, carry), "digests").withColumn(
        "run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int")
    )
    first = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id"), F.col("row"))
    levels = [merge(rows.select("run", *DIGEST, first.alias("head"), F.lit(1).alias("n")), F.col("run"))]
    left = runs
    while left > 1:
        left = -(-left // fan)
        levels.append(merge(levels[-1], F.floor(F.col("run") / fan).cast("int")))
    winners = levels[-1].filter("n > 1").select("run", *DIGEST, "head", "n")
    for level in reversed(levels[:-1]):
        below = level.select(F.col("run").alias("own"), F.floor(F.col("run") / fan).cast("int").alias("run"), *DIGEST)
        winners = below.join(winners, ["run", *DIGEST]).drop("run").withColumnRenamed("own", "run")
    found = rows.join(winners, ["run", *DIGEST], "left")
    alone = F.col("head").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("head.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *carry,
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns of the input."""
    return keep_rows(docs, exact_classes(keyed_texts(docs), KEY).filter("kept"))
