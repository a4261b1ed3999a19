"""Connected components: forests of bounded chunks, then alternating star contraction.

Edges are cut into chunks of at most ``CHUNK`` edges; a task replaces each chunk by its
spanning forest, every node with the smallest node of its component inside the chunk.
While there is more than one chunk, a round of Spark joins points all larger neighbours of
a node at its smallest neighbour, then all smaller ones, and the chunks are folded again,
until the edges no longer change; each node then has one edge, to the smallest node of its
component. Each round is written to the shared folder and the one before is deleted, so
lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.staging import file_system, staged_path

CHUNK = 250_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node) of every node that is not the smallest of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while (label[left] != label[right]).any():
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        label = label[label]
    while (label != label[label]).any():
        label = label[label]
    found = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[found], nodes[label[found]]


def _folded(edges: DataFrame, count: int) -> DataFrame:
    """Forests of chunks; ``edges`` is a written table of ``count`` rows."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for rows in batches:
            held.append(rows)
            size += len(rows)
            if size >= CHUNK:
                both = pd.concat(held)
                yield pd.DataFrame(dict(zip("ab", forest(both["a"].to_numpy(), both["b"].to_numpy()))))
                held, size = [], 0
        if held:
            both = pd.concat(held)
            yield pd.DataFrame(dict(zip("ab", forest(both["a"].to_numpy(), both["b"].to_numpy()))))

    return edges.coalesce(chunks(count)).mapInPandas(fold, "a long, b long")


def chunks(count: int) -> int:
    return max(1, -(-count // CHUNK))


def _star(edges: DataFrame) -> DataFrame:
    """Large star, then small star, over edges (a, b) with a > b."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    lowest = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(lowest).distinct()


def _written(spark: SparkSession, edges: DataFrame) -> tuple[str, DataFrame, tuple]:
    path = staged_path(edges, "edges")
    table = spark.read.schema("a long, b long").parquet(path)
    mark = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return path, table, tuple(mark)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge and is not itself the root.

    ``edges`` has long columns a and b in any order; loops and repeats are ignored. The
    root is the smallest node of the component.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    path, table, mark = _written(spark, ordered.distinct())
    while True:
        older, before = path, mark
        alone = chunks(mark[0]) == 1
        path, table, mark = _written(spark, _folded(table if alone else _star(table), before[0]))
        system, place = file_system(spark, older)
        system.delete(place, True)
        if alone or mark == before:
            return table.select(F.col("a").alias("node"), F.col("b").alias("root"))
