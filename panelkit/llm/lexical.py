"""Ranked lexical search: exact top k documents of every item by a dual-tree search.

Terms, weights and scores are those of ``score`` below: a score is the inner product of an
item's vector (weight times occurrences) and a document's vector (saturated frequency),
both non-negative integers.

One pass over the texts writes, for every document, its number of terms and the
frequencies of the terms that occur in items. Document frequencies and totals are counted
from that table by Spark. Then every task puts its documents into trees: neighbours share
their heaviest coordinates, and a node holds the coordinate-wise maxima of what is below.
Items have a tree of the same kind. The search walks pairs of nodes downwards. The inner
product of two nodes bounds every score below them; a pair whose bound is less than the
weakest k-th score of its items is left out whole, which loses nothing. Before the main
search the same search over one document in ``SEED`` gives every item a floor, a score that its
k-th document reaches at least; floors make tasks return few rows and nothing else.

Items come in blocks of bounded size, one after the other, so that what is broadcast does not
grow with the query set. Documents are never shuffled; only candidates are.

Defined results: every row of ``items`` is a query and every row of ``docs`` a document;
repeated rows are ranked each. NULL and empty texts have no terms: such an item has no
rows and such a document is never found. Equal scores are ordered by doc_id, NULL first.
Empty tables give no rows. Other columns are ignored. Whole texts count. Scores are exact as
long as an item has fewer than 1e8 terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.staging import stage

K = 20
SEED = 64  # one document in so many gives the floors
CELLS = 1 << 22  # most cells of a matrix over items or nodes, and the distinct terms of a block
FAN = 8  # children of a node
LEAF = 8  # documents of a leaf
SLOPE = 12  # of the length norm m, against 1000 of the frequency

VECTORS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
FOUND = "query int, item_id bigint, doc_id bigint, score bigint"


def letter_table() -> bytes:
    """Maps bytes so that terms are what stands between spaces: A-Z lower, other ASCII signs space."""
    kept = [chr(c).lower().encode() if chr(c).isalnum() else b" " for c in range(128)]
    return b"".join(kept) + bytes(range(128, 256))


TERMS = letter_table()


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERMS).split()


# --- items ----------------------------------------------------------------------


@dataclass
class Block:
    """Some items, their terms, and the occurrences of terms in items."""

    ids: list[int | None] = field(default_factory=list)
    counts: list[Counter] = field(default_factory=list)
    terms: dict[bytes, int] = field(default_factory=dict)

    def fits(self, counts: Counter) -> bool:
        more = len(counts.keys() - self.terms.keys())
        return not self.ids or (len(self.ids) + 1) * (len(self.terms) + more) <= CELLS

    def add(self, item_id: int | None, counts: Counter) -> None:
        self.ids.append(item_id)
        self.counts.append(counts)
        for term in counts:
            self.terms.setdefault(term, len(self.terms))

    def matrix(self, weights: np.ndarray) -> np.ndarray:
        """Weight times occurrences, a row per item."""
        out = np.zeros((len(self.ids), len(self.terms)), dtype=np.int64)
        for row, counts in enumerate(self.counts):
            for term, n in counts.items():
                out[row, self.terms[term]] = n * weights[self.terms[term]]
        return out


def blocks_of(items: DataFrame) -> Iterator[Block]:
    """Items with terms in blocks of bounded size, read one partition at a time."""
    block = Block()
    for row in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        counts = Counter(terms_of(row.text))
        if not counts:
            continue
        if not block.fits(counts):
            yield block
            block = Block()
        block.add(row.item_id, counts)
    if block.ids:
        yield block


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- trees ----------------------------------------------------------------------


def levels_of(rows: np.ndarray, fan: int = FAN, most: int = 2) -> list[np.ndarray]:
    """Rows and above them the maxima of ``fan`` neighbours each, ``most`` times."""
    out = [rows]
    for _ in range(most):
        out.append(np.maximum.reduceat(out[-1], np.arange(0, len(out[-1]), fan), axis=0))
    return out


class Items:
    """Tree over the items of a block with the best documents of each so far."""

    def __init__(self, matrix: np.ndarray, floors: np.ndarray, k: int):
        common = np.where(matrix > 0, matrix, np.iinfo(np.int64).max).argmin(axis=1)
        self.order = np.lexsort((matrix.argmax(axis=1), common))
        self.levels = levels_of(matrix[self.order])
        self.floors, self.k = floors[self.order], k
        self.best = [None] * len(matrix)
        self.weakest = [np.maximum(self.floors, 1)]
        self.renew()

    def renew(self) -> None:
        """Weakest k-th score below every node."""
        del self.weakest[1:]
        for _ in self.levels[1:]:
            last = self.weakest[-1]
            self.weakest.append(np.minimum.reduceat(last, np.arange(0, len(last), FAN)))

    def children(self, nodes: np.ndarray, level: int) -> np.ndarray:
        """Nodes below those of ``level``."""
        below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return below[below < len(self.levels[level - 1])]

    def offer(self, item: int, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> bool:
        """Keep the k best of what was kept and what is offered; whether the k-th rose."""
        if self.best[item] is not None:
            scores, known, ids = map(np.concatenate, zip(self.best[item], (scores, known, ids)))
        first = np.lexsort((ids, known, -scores))[: self.k]
        self.best[item] = scores[first], known[first], ids[first]
        if len(first) < self.k or scores[first[-1]] <= self.weakest[0][item]:
            return False
        self.weakest[0][item] = scores[first[-1]]
        return True


class Documents:
    """Tree over a batch of documents, given as sparse rows sorted by document."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, owner: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray):
        heavy = np.lexsort((-weights[terms] * values, owner))
        first = np.concatenate([[True], owner[heavy][1:] != owner[heavy][:-1]])
        lead = terms[heavy][first]  # heaviest coordinate of every document
        second = np.where(np.append(first[1:], True), -1, np.append(terms[heavy][1:], -1))[first]
        place = np.empty(len(lead), dtype=np.int64)
        place[np.lexsort((second, lead))] = np.arange(len(lead))
        row = place[owner]
        order = np.argsort(row, kind="stable")
        self.row, self.terms, self.values = row[order], terms[order], values[order]
        back = np.argsort(place)
        self.ids, self.known = ids[back], known[back]
        leaves = -(-len(lead) // LEAF)
        maxima = np.zeros(leaves * len(weights), dtype=np.int64)
        np.maximum.at(maxima, (self.row // LEAF) * len(weights) + self.terms, self.values)
        self.levels = levels_of(maxima.reshape(leaves, len(weights)))
        self.starts = np.searchsorted(self.row, np.arange(0, leaves + 1) * LEAF)

    def leaf(self, at: int, columns: np.ndarray, width: int) -> np.ndarray:
        """Values of a leaf's documents in the given columns."""
        own = slice(self.starts[at], self.starts[at + 1])
        slot = np.zeros(width, dtype=np.int64)
        slot[columns] = np.arange(len(columns))
        out = np.zeros((min(LEAF, len(self.ids) - at * LEAF), len(columns)), dtype=np.int64)
        out[self.row[own] - at * LEAF, slot[self.terms[own]]] = self.values[own]
        return out


def search(items: Items, docs: Documents) -> int:
    """Offer every document that may belong to an item's best; the number of pairs scored."""
    scored, width = 0, docs.levels[0].shape[1]
    top = len(docs.levels) - 1
    waiting = [(top, at, np.arange(len(items.levels[top]))) for at in range(len(docs.levels[top]))]
    while waiting:
        level, at, nodes = waiting.pop()
        columns = np.flatnonzero(docs.levels[level][at])
        bounds = items.levels[level][np.ix_(nodes, columns)] @ docs.levels[level][at][columns]
        nodes = nodes[bounds >= items.weakest[level][nodes]]
        if not len(nodes):
            continue
        if level:
            below = items.children(nodes, level)
            last = min((at + 1) * FAN, len(docs.levels[level - 1]))
            waiting.extend((level - 1, child, below) for child in range(at * FAN, last))
            continue
        scores = items.levels[0][np.ix_(nodes, columns)] @ docs.leaf(at, columns, width).T
        scored += scores.size
        good = scores >= items.weakest[0][nodes][:, None]
        rose = False
        for row in np.flatnonzero(good.any(axis=1)).tolist():
            own = np.flatnonzero(good[row]) + at * LEAF
            rose |= items.offer(int(nodes[row]), scores[row][good[row]], docs.known[own], docs.ids[own])
        if rose:
            items.renew()
    return scored


# --- jobs -----------------------------------------------------------------------


def vectors_of(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Number of terms of every document, and which of ``terms`` it has how often."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, found = [], []
                for text in part.column(1):
                    words = terms_of(text.as_py())
                    sizes.append(len(words))
                    own = np.array([i for i in map(get, words) if i is not None], dtype=np.int32)
                    found.append(np.unique(own, return_counts=True))
                offsets = pa.array(np.cumsum([0, *(len(t) for t, _ in found)]), type=pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(np.int32)))
                    for x in zip(*found)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, type=pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, VECTORS)


def find(vectors: DataFrame, block: Block, weights: np.ndarray, floors: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The k best documents of every item in each task, as far as they reach the floors."""
    shared = vectors.sparkSession.sparkContext.broadcast((block.ids, block.matrix(weights), weights, floors))
    most = max(LEAF, CELLS // max(1, len(weights)) * LEAF)  # documents of a tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, weights, floors = shared.value
        items = Items(matrix, floors, k)
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                sizes = np.diff(part.column(2).offsets.to_numpy())
                some = np.flatnonzero(sizes)
                if not len(some):
                    continue
                known = part.column(0).is_valid().to_numpy(zero_copy_only=False)
                doc_ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(some)), sizes[some])
                norm = 75 + (25 * part.column(1).to_numpy() * n_docs) // n_terms
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                values = (10**9 * tf) // (1000 * tf + SLOPE * norm[some][owner])
                terms = part.column(2).flatten().to_numpy()
                search(items, Documents(doc_ids[some], known[some], owner, terms, values, weights))
        for item, best in zip(items.order.tolist(), items.best):
            if best is not None:
                scores, known, found = best
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(scores), type=pa.int32()),
                        pa.array([ids[item]] * len(scores), type=pa.int64()),
                        pa.array(found, type=pa.int64(), mask=~known),
                        pa.array(scores, type=pa.int64()),
                    ],
                    names=["query", "item_id", "doc_id", "score"],
                )

    return vectors.where("n > 0").mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query with their rank."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    vectors = stage(vectors_of(docs, block.terms), "term_vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(block.terms), dtype=np.int64)  # at most CELLS
    for term, df in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        holding[term] = df
    weights = np.array([weight(n_docs, int(df)) for df in holding], dtype=np.int64)
    floors = np.zeros(len(block.ids), dtype=np.int64)
    few = vectors.where(F.pmod(F.xxhash64("doc_id"), F.lit(SEED)) == 0)
    seeds = best_of(find(few, block, weights, floors, n_docs, n_terms, k), k).where(F.col("rank") == k)
    for row in seeds.select("query", "score").collect():  # at most one row an item
        floors[row.query] = row.score
    return best_of(find(vectors, block, weights, floors, n_docs, n_terms, k), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    spark = docs.sparkSession
    found = [search_block(docs, block, k) for block in blocks_of(items)]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id, unnest(list_filter(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term
  FROM benchmark),
s AS (SELECT count(*) FILTER (len(words) > 0) AS docs, sum(len(words))::BIGINT AS terms FROM d),
tf AS (SELECT r, doc_id, len(words) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, words, unnest(words) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0 * docs + 2) / (2.0 * count(*) + 1)))::BIGINT AS w
  FROM tf, s GROUP BY term, docs),
scored AS (
  SELECT q, item_id, r, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term), s GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
