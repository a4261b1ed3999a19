"""Quality rules and a hashed n-gram likelihood ratio, in DataFrame functions only.

The verdict of the method: every word and every pair of neighbouring words falls into one
of ``BUCKETS`` hash buckets. A multinomial over the buckets is counted on trusted
documents (labelled quality 1 and not toxic) and one on all documents. A document's score
is the sum of the log ratios of its n-grams, divided by their number plus ``PRIOR``, and
the document passes if the score is at least ``THRESHOLD``. No draw is involved.

The trusted side is fitted on at most ``TRUSTED`` labelled rows, those with the smallest
hash of doc_id, so the broadcast list has a fixed bound; raw counts cover every document.

Defined results: NULL text has no words, fails the base rules and scores 0. Without any
trusted document all scores are 0. Repeated rows are judged row by row; a NULL doc_id is
never trusted. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import let, words_of

BUCKETS = 1 << 14
TRUSTED = 4096
SMOOTHING = 10.0  # pseudo counts of a bucket, on the scale of the trusted total on both sides
PRIOR = 20
THRESHOLD = -0.05
WINDOW = 5


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """At most ``bound`` trusted ids, each once."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id")
    ids = good.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    return ids.withColumn("trusted", F.lit(1))


def bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets).cast("long")).cast("int")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def ngram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and all neighbouring pairs."""

    def pair(h: Column, i: Column) -> Column:
        return bucket(F.xxhash64(h, F.get(hashes, i + 1)), buckets)

    last = F.size(hashes) - 1
    pairs = F.transform(F.slice(hashes, 1, F.greatest(last, F.lit(0))), pair)
    return F.concat(F.transform(hashes, lambda h: bucket(h, buckets)), pairs)


def bucket_counts(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = TRUSTED) -> DataFrame:
    """bucket, raw, trusted: counts over all documents."""
    known = docs.select("doc_id", "text").join(F.broadcast(trusted_ids(labels, bound)), "doc_id", "left")
    grams = let(word_hashes(words_of(F.col("text"))), lambda h: ngram_buckets(h, buckets))
    each = known.select(F.coalesce("trusted", F.lit(0)).alias("t"), F.explode(grams).alias("bucket"))
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("trusted"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """Weight of every bucket; ``counts`` has at most ``buckets`` rows."""
    rows = {r.bucket: (r.trusted, r.raw) for r in counts.collect()}
    trusted, raw = (sum(r[i] for r in rows.values()) for i in (0, 1))
    if not trusted:
        return [0.0] * buckets
    pairs = (rows.get(b, (0, 0)) for b in range(buckets))
    return [math.log(t + smoothing) - math.log(r * trusted / raw + smoothing) for t, r in pairs]


def table_literal(weights: list[float]) -> Column:
    """The weights as one array constant; the optimiser folds the cast."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def score(hashes: Column, weights: Column, buckets: int, prior: int) -> Column:
    n = F.size(hashes)
    total = F.aggregate(ngram_buckets(hashes, buckets), F.lit(0.0), lambda s, b: s + F.get(weights, b))
    return F.when(n > 0, total / (2 * n - 1 + prior)).otherwise(F.lit(0.0))


def repeated_words(hashes: Column, width: int = WINDOW) -> Column:
    """Number of words inside windows that occur twice or more in the text."""

    def starts(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(pairs: Column) -> Column:
            def same(p: Column, k: Column) -> Column:
                before = F.get(pairs, k - 1)["h"] == p["h"]
                after = F.get(pairs, k + 1)["h"] == p["h"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.sort_array(F.transform(F.filter(pairs, same), lambda p: p["i"]))

        return let(ordered, again)

    def covered(places: Column) -> Column:
        zero = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        step = lambda s, p: F.struct(
            p.alias("last"), (s["n"] + F.least(F.lit(width), p - s["last"])).alias("n")
        )
        return F.aggregate(places, zero, step, lambda s: s["n"])

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])

    made = F.transform(F.sequence(F.lit(0), F.size(hashes) - width), window)
    counted = let(
        made,
        lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(starts(w))).otherwise(F.lit(0)),
    )
    return F.when(F.size(hashes) >= width, counted).otherwise(F.lit(0))


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    """Measures that need no word hashes."""
    joined = F.array_join(words, "")
    plain = joined
    for symbol in "#*$%&|<>":
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    return {
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": (F.length(joined) - F.length(plain)).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def judge(
    docs: DataFrame,
    weights: list[float],
    buckets: int = BUCKETS,
    prior: int = PRIOR,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Measures, score and verdict of every row."""
    constant = table_literal(weights)
    measured = let(
        word_hashes(F.col("words")),
        lambda h: F.struct(
            F.size(h).cast("long").alias("n_words"),
            repeated_words(h).cast("long").alias("n_repeat_words"),
            score(h, constant, buckets, prior).alias("score"),
        ),
    )
    split = docs.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    base = base_columns(F.col("text"), F.col("words"))
    rows = split.select("doc_id", *[c.alias(n) for n, c in base.items()], measured.alias("m"))
    failed = (F.col("m.n_words") < 10) | (100 * F.col("m.n_repeat_words") > 20 * F.col("m.n_words"))
    return rows.select(
        "doc_id",
        "m.n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "m.n_repeat_words",
        failed.alias("base_failed"),
        "m.score",
        (~failed & (F.col("m.score") >= threshold)).alias("kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document judged with the production settings."""
    return judge(docs, log_ratios(bucket_counts(docs, labels)))
