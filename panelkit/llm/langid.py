"""Language identification by nearest centroid.

A text becomes a vector of hashed letter n-grams (1 to 3 bytes of the lower-cased text,
all that is not a letter being one separator), weighted by log term frequency and inverse
document frequency and scaled to length 1. Each language has ``CENTROIDS`` centroids from
spherical clustering; a text gets the language of the centroid with the highest cosine.
If the distance (1 - cosine) exceeds the limit, the text is rejected. Short texts lie farther,
so the limit has a part for long texts and one that falls with the root of the number of
characters. Both are high quantiles over all training rows, not the worst row, and lie within
fixed bounds, so that they hardly depend on the sample. Languages that were not taught, random
letters and base64 are beyond them at any length; random hexadecimal digits and program code are
about as far as junk among the labelled rows and are mostly kept.

The model is fitted on at most ``PER_LANGUAGE`` labelled rows of a language and ``SAMPLE``
rows in all, those with the smallest hash of doc_id, of documents outside the held-out
fifth; so what reaches the driver has a fixed bound. Every text is predicted as a whole.

Defined results: NULL text and text without a letter are ``und`` with score 0 and are
rejected. Repeated rows are predicted each and teach once; an empty table gives no rows; texts of
any length are read whole, in blocks; further columns do not matter. Rows with NULL lang teach nothing; NULL doc_id counts as the text ''. Without
any labelled row all texts are ``und``. Ties go to the alphabetically first language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.llm.common import whole_rows

DIMS_LOG2 = 12
CENTROIDS = 4
PER_LANGUAGE, SAMPLE = 512, 2048
ROUNDS = 12
KEPT = 0.999  # quantile of the training distances that the limits keep
SLACK = 1.1  # times the quantile
NEAREST, FARTHEST = 0.65, 0.72  # bounds of the limit of long texts
SHORT = 1.0  # least part for short texts
LONG = 300  # characters from which the length of a text hardly matters

LETTER = re.compile(r"[^\W\d_]")
def has_letter(text: str | None) -> bool:
    return text is not None and any(m[0].isalpha() for m in LETTER.finditer(text))


KEEP = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray
    limit: float  # of long texts
    short: float  # beyond that, by the root of the number of characters


def limits_of(distances: np.ndarray, sizes: np.ndarray) -> tuple[float, float]:
    """(limit of long texts, what a text of one character may lie farther)."""
    long = distances[sizes >= LONG] if (sizes >= LONG).any() else distances
    limit = float(np.clip(SLACK * np.quantile(long, KEPT), NEAREST, FARTHEST))
    return limit, max(SHORT, SLACK * float(np.quantile((distances - limit) * np.sqrt(sizes), KEPT)))


def gram_counts(text: str) -> np.ndarray:
    """Hashed counts of the 1- to 3-byte grams of a whole text, block by block."""
    data = re.sub(rb" +", b" ", b" " + text.lower().encode().translate(KEEP) + b" ")
    counts = np.zeros(1 << DIMS_LOG2, dtype=np.float32)
    block = 1 << 20
    for at in range(0, len(data), block):
        one = np.frombuffer(data[at : at + block + 2], dtype=np.uint8).astype(np.uint32)
        code = np.zeros(len(one), dtype=np.uint32)
        for n in (1, 2, 3):
            if len(one) < n:
                break
            code = (code[: len(one) - n + 1] << np.uint32(8)) | one[n - 1 :]
            slot = ((code + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - DIMS_LOG2)
            counts += np.bincount(slot[:block], minlength=len(counts))
    return counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    return weighted / np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)


def cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means with farthest-first starts; deterministic."""
    picks = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(picks) < min(k, len(x)):
        picks.append(int(np.argmin((x @ x[picks].T).max(axis=1))))
    centres = x[picks]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = SAMPLE) -> DataFrame:
    """lang, size and gram counts of the bounded training sample."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    token = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    order = Window.partitionBy("lang").orderBy("token", "doc_id")
    # the smallest hashes lie below a share that is about twice what is wanted, so only few rows are ranked
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows)
    below = counts.select("lang", (F.lit(float(1 << 31)) * (2 * per_language + 64) / F.col("n")).alias("below"))
    near = usable.select("doc_id", "lang", token.alias("token")).join(F.broadcast(below), "lang").filter("token < below")
    ranked = near.select("doc_id", "lang", F.row_number().over(order).alias("rank"))
    few = ranked.filter(F.col("rank") <= per_language).orderBy("rank", "lang", "doc_id").limit(rows)
    chosen = usable.select("doc_id", "lang", "text").join(F.broadcast(few.select("doc_id", "lang").distinct()), ["doc_id", "lang"])

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[[has_letter(t) for t in b["text"]]]
            made = [gram_counts(t).tobytes() for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "size": b["text"].str.len(), "grams": made})

    made = chosen.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text").mapInPandas(
        grams, "doc_id string, lang string, size long, grams binary"
    )
    # of repeated rows one, and the same ones if ids with several texts go beyond the bound
    return made.distinct().orderBy("lang", "doc_id", "size", "grams").limit(rows).drop("doc_id")


def fit(docs: DataFrame) -> Model:
    """A model of bounded size; its training rows are ordered by value, so it is deterministic."""
    taught = sample(docs).toPandas().sort_values(["lang", "grams"], ignore_index=True)
    width = 1 << DIMS_LOG2
    counts = np.frombuffer(b"".join(taught["grams"]), dtype=np.float32).reshape(-1, width)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = vectors(counts, idf)
    names: list[str] = []
    centres, distances = [np.zeros((0, width), dtype=np.float32)], np.zeros(len(x))
    for lang in sorted(taught["lang"].unique()):
        own = x[(taught["lang"] == lang).to_numpy()]
        made = cluster(own, CENTROIDS)
        distances[(taught["lang"] == lang).to_numpy()] = 1 - (own @ made.T).max(axis=1)
        names += [lang] * len(made)
        centres.append(made)
    limit, short = limits_of(distances, taught["size"].to_numpy()) if len(x) else (0.0, 0.0)
    return Model(names, idf, np.concatenate(centres).astype(np.float32), limit, short)


def predictor(model: Model):
    """Function of a text column: struct of lang_pred, score, distance, rejected."""

    @F.pandas_udf("lang_pred string, score double, distance double, rejected boolean")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        found = np.array([has_letter(t) for t in texts], dtype=bool)
        found &= len(model.languages) > 0
        score, best = np.zeros(len(texts)), np.zeros(len(texts), dtype=int)
        at = np.flatnonzero(found)
        for i in range(0, len(at), 256):
            some = at[i : i + 256]
            x = vectors(np.stack([gram_counts(texts.iat[j]) for j in some]), model.idf)
            cosine = x @ model.centroids.T
            best[some] = cosine.argmax(axis=1)
            score[some] = np.clip(cosine.max(axis=1), 0, 1)
        names = [model.languages[j] if ok else "und" for j, ok in zip(best, found)]
        limit = np.array([model.limit + model.short / np.sqrt(len(t)) if ok else -1.0 for t, ok in zip(texts, found)])
        return pd.DataFrame(
            {"lang_pred": names, "score": score, "distance": 1 - score, "rejected": 1 - score > limit}
        )

    return nearest


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, distance, rejected."""
    found = predictor(fit(docs))("text").alias("found")
    return docs.select("doc_id", held_out().alias("held_out"), found).select("doc_id", "held_out", "found.*")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents whose language is recognised, with the columns of the input."""
    found = predictor(fit(docs))("whole.text").alias("found")
    return whole_rows(docs).select("whole", found).filter(~F.col("found.rejected")).select("whole.*")
