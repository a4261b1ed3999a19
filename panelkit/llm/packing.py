"""Packing into optimal length buckets.

A document's tokens are the UTF-8 bytes of its text and one end token (the vocabulary of
byte-level models), or a given column. Documents longer than ``CONTEXT`` are cut into
pieces of that length, so piece lengths are 1 to CONTEXT and their global histogram has at
most CONTEXT rows. Dynamic programming over the histogram finds the ``BUCKETS`` boundaries
with the least padding of all choices. Inside each bucket the pieces are numbered without
gaps and cut into batches of at most ``BATCH_TOKENS`` tokens, padding included.

Defined results: NULL and empty text have one token. Repeated rows are packed each. With
fewer lengths than buckets every length has its own. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import numbered
from panelkit.staging import stage

CONTEXT = 8192
BUCKETS = 16
BATCH_TOKENS = 65_536


def byte_tokens() -> Column:
    return F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1


def histogram(lengths: DataFrame, context: int) -> DataFrame:
    """length, n of all pieces; at most ``context`` rows."""
    full = F.struct(F.lit(context).cast("long").alias("length"), F.floor(F.col("n_tokens") / context).alias("n"))
    rest = F.struct((F.col("n_tokens") % context).alias("length"), F.lit(1).cast("long").alias("n"))
    parts = lengths.select(F.explode(F.array(full, rest)).alias("p")).filter("p.length > 0 AND p.n > 0")
    return parts.groupBy("p.length").agg(F.sum("p.n").alias("n"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    ``best[j]`` is the least number of padded tokens of the first j lengths; one more
    bucket from length i on adds (count of i+1..j) x length j.
    """
    size = len(lengths)
    if not size:
        return []
    before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    top = np.concatenate([[0], lengths]).astype(np.int64)
    best = np.concatenate([[0], before[1:] * top[1:]])
    choices = [np.zeros(size + 1, dtype=np.int64)]
    for _ in range(min(buckets, size) - 1):
        older, best, from_ = best, best.copy(), np.zeros(size + 1, dtype=np.int64)
        for j in range(1, size + 1):
            cost = older[:j] + (before[j] - before[:j]) * top[j]
            from_[j] = cost.argmin()
            best[j] = cost[from_[j]]
        choices.append(from_)
    bounds, j = [], size
    for from_ in reversed(choices):
        if j == 0:
            break
        bounds.append(int(top[j]))
        j = int(from_[j])
    return bounds[::-1]


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    context: int = CONTEXT,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens, bucket, boundary, batch, slot."""
    if batch_tokens < context:
        raise ValueError("a batch must hold at least one piece of full length")
    count = byte_tokens() if tokens is None else tokens
    lengths = stage(docs.select("doc_id", count.cast("long").alias("n_tokens")), "lengths")
    rows = sorted((r.length, r.n) for r in histogram(lengths, context).collect())
    bounds = boundaries(*(np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1)), buckets)
    last = F.floor((F.col("n_tokens") - 1) / context)
    pieces = lengths.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    first = F.col("piece") * context
    bound_list = F.array(*[F.lit(b) for b in bounds]).cast("array<int>")
    placed = pieces.select(
        "doc_id", "piece", first.alias("first_token"), F.least(F.lit(context), F.col("n_tokens") - first).alias("n_tokens")
    ).withColumn("bucket", F.size(F.filter(bound_list, lambda b: b < F.col("n_tokens"))))
    ranked = numbered(placed, "bucket", ["doc_id", "piece", "n_tokens"], "place").withColumn(
        "boundary", F.get(bound_list, F.col("bucket"))
    )
    per_batch = F.floor(F.lit(batch_tokens) / F.col("boundary"))
    return ranked.select(
        "doc_id",
        "piece",
        "first_token",
        "n_tokens",
        "bucket",
        "boundary",
        F.floor(F.col("place") / per_batch).alias("batch"),
        (F.col("place") % per_batch).alias("slot"),
    )
