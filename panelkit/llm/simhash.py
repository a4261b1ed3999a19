"""SimHash near duplicates with pivot distance tables.

A fingerprint has 64 bits; two link at ``LIMIT`` or fewer differing bits. For every
distinct fingerprint the Hamming distances to ``PIVOTS`` reference fingerprints are
computed once. By the triangle inequality two fingerprints whose distances to any pivot
differ by more than the limit can't link, so a pair is discarded by its maximum
coordinate difference and only survivors are compared bit by bit.

One pivot keeps about half of all pairs, so a table over whole fingerprints would still
have to look at all of them. The pivots of a facet bring them together instead: the bits
are cut into ``bands`` bands, and of two linked fingerprints all but ``LIMIT`` bands are
equal, that is, in one of the facets (each set of bands - LIMIT bands) both are at distance
0 from the same reference. Facet and reference name a cell; pairs are formed inside cells
only. More bands make finer cells and are chosen from the number of fingerprints; every
choice finds all links.

A cell larger than ``BLOCK`` is cut into blocks by hash and each pair of blocks is a task
of its own. A cell gives no pairs but a forest: every fingerprint with the first of its
local component. Components are then contracted with Spark joins. Copies are folded to one
fingerprint before and joined back after.

Defined results: NULL text is empty; texts without words have fingerprint zero and link
like others. component_id is the smallest doc_id that is not NULL, or NULL. Rows with
the same doc_id are rows of their own. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import KEY, keep_rows, keyed_texts
from panelkit.llm.components import connected
from panelkit.staging import stage

LIMIT = 4
PIVOTS = 16
BLOCK = 1024
SHINGLE = 4
CELL_ROWS = 8  # aimed at fingerprints per cell, if they were spread evenly


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    total = len(words) - width + 1
    set_bits = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, 1 << 16):
        here = slice(at, min(total, at + (1 << 16)))
        spans = zip(starts[here].tolist(), ends[here.start + width - 1 : here.stop + width - 1].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp and ``carry`` of every document."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", prints("text").alias("fp"), *carry)


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}") for i in range(count)], dtype=np.uint64)


def add_distances(prints: DataFrame, count: int = PIVOTS) -> DataFrame:
    """The pivot distance table: one byte per pivot."""
    reference = pivots(count)

    @F.pandas_udf("binary")
    def distances(fp: pd.Series) -> pd.Series:
        bits = np.bitwise_count(fp.to_numpy().astype(np.int64).view(np.uint64)[:, None] ^ reference[None, :])
        return pd.Series([row.tobytes() for row in bits.astype(np.uint8)])

    return prints.withColumn("distances", distances("fp"))


def band_count(fingerprints: int, limit: int = LIMIT) -> int:
    """Smallest number of bands whose cells would hold few fingerprints."""
    bands = limit + 1
    while bands < 2 * limit and fingerprints > CELL_ROWS * 2 ** (64 * (bands - limit) // bands):
        bands += 1
    return bands


def facet_masks(bands: int, limit: int = LIMIT) -> list[int]:
    """Bit masks of every choice of bands - limit bands, as signed longs."""
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(masks, bands - limit)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in chosen]


def forest(cell: np.ndarray, fp: np.ndarray, table: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, first of its local component) for rows sorted by cell."""
    left, right = [], []
    i, step = np.arange(len(fp)), 1
    while True:
        i = i[i + step < len(fp)]
        i = i[cell[i] == cell[i + step]]
        if not len(i):
            break
        a = i
        for column in table.T:  # maximum coordinate difference, one pivot after the other
            a = a[np.abs(column[a] - column[a + step]) <= limit]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= limit]
        left.append(a)
        right.append(a + step)
        step += 1
    label = np.arange(len(fp))
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        while len(a) and (label[a] != label[b]).any():
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
    found = np.flatnonzero(label != np.arange(len(fp)))
    return fp[found], fp[label[found]]


def links(prints: DataFrame, bands: int, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all links between fingerprints."""
    masks = facet_masks(bands, limit)
    facets = F.array(
        *[F.struct(F.lit(i).alias("facet"), F.col("fp").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks)]
    )
    cells = prints.select("fp", "distances", F.explode(facets).alias("c")).select("fp", "distances", "c.facet", "c.cell")
    large = cells.groupBy("facet", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = stage(large, "large_cells")  # mostly empty: with its size known, cells need no shuffle to meet it
    blocks = F.ceil(F.coalesce("n", F.lit(1)) * 2 / block)
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = (
        cells.join(large, ["facet", "cell"], "left")
        .select("fp", "distances", "facet", "cell", blocks.alias("blocks"))
        .select("fp", "distances", "facet", "cell", own.alias("own"), other)
        .select(
            "fp", "distances", "facet", "cell", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")
        )
    )
    place = ["facet", "cell", "p", "q"]

    def edges(rows: pd.DataFrame, same: np.ndarray) -> pd.DataFrame:
        table = np.frombuffer(b"".join(rows["distances"]), dtype=np.uint8).reshape(len(rows), -1).astype(np.int8)
        a, b = forest(np.cumsum(~same), rows["fp"].to_numpy().view(np.uint64), table, limit)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in batches:
            rows = rows if held is None else pd.concat([held, rows], ignore_index=True)
            keys = rows[place].to_numpy()
            same = np.append(False, (keys[1:] == keys[:-1]).all(axis=1))[: len(rows)]
            starts = np.flatnonzero(~same)
            cut = int(starts[-1]) if len(starts) else 0
            if cut:
                yield edges(rows.iloc[:cut], same[:cut])
            held = rows.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield edges(held, np.arange(len(held)) > 0)

    near = dealt.repartition(*place).sortWithinPartitions(*place)
    return near.mapInPandas(walk, "a long, b long")


def simhash_classes(docs: DataFrame, carry: tuple[str, ...] = (), limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, root and ``carry``."""
    marked = stage(fingerprints(docs, carry), "fingerprints")
    prints = stage(
        add_distances(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))), "distances"
    )
    roots = connected(links(prints, band_count(prints.count(), limit), limit, block).distinct())
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    classes = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = placed.select("fp", "root").join(classes, "root")
    return marked.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root", *carry
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id."""
    rows = simhash_classes(keyed_texts(docs), KEY)
    order = F.struct(F.col("doc_id").isNull().alias("absent"), F.col("doc_id"), *KEY)
    first = rows.groupBy("root").agg(F.min(order).alias("f"))
    return keep_rows(docs, first.select(*[F.col(f"f.{k}").alias(k) for k in KEY]))
