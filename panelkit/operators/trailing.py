"""Aggregates of trailing windows from monthly pieces.

A row is moved once, to its key. Rows arrive sorted by key, and a task holds a few whole keys at
a time: their windows are counted, summed and their medians picked from arrays.

A key is held by one task only if it was counted and is below ``max_group`` rows. Rows of
larger keys go the long way, one copy per window, through percentiles that split groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from panelkit.operators.ordering import group_limit
from panelkit.operators.quantiles import grouped_percentiles
from panelkit.staging import stage

TASK_ROWS = 250_000  # rows of a task, unless it has a key with more
BATCH_ROWS = 65_536  # rows whose windows are made at once, unless a key has more


def trailing_cells(
    df: DataFrame,
    keys: Sequence[str],
    month: str,
    medians: Mapping[str, str],
    sums: Mapping[str, Column],
    spans: Sequence[int],
    max_group: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per (keys, end month, span) with at least one row of ``df`` in its window.

    ``month`` is an integer month number. Columns: keys, ``end_month``, ``span``, ``n``, the
    ``sums`` as doubles and the exact ``medians`` of the named columns. A missing key is a key. The number of ``rows`` can be
    given if it is known.
    """
    max_group = group_limit(df.sparkSession, max_group)
    rows = df.count() if rows is None else rows
    if rows <= max_group:
        return _from_rows(df, keys, month, medians, sums, spans, rows)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_group)
    large = stage(sizes.select(*[F.col(k).alias(f"_large_{k}") for k in keys]), "large_keys")
    if large.isEmpty():
        return _from_rows(df, keys, month, medians, sums, spans, rows)
    same = [F.col(k).eqNullSafe(F.col(f"_large_{k}")) for k in keys]
    usual = _from_rows(df.join(large, same, "left_anti"), keys, month, medians, sums, spans, rows)
    copied = _from_copies(df.join(large, same, "left_semi"), keys, month, medians, sums, spans, max_group)
    return usual.unionByName(copied)


def _from_rows(df, keys, month, medians, sums, spans, rows) -> DataFrame:
    totals = [c.cast("double").alias(f"_s_{n}") for n, c in sums.items()]
    values = [F.col(c).cast("double").alias(f"_v_{n}") for n, c in medians.items()]
    narrow = df.filter(F.col(month).isNotNull()).select(*keys, month, *totals, *values)
    # The number of tasks follows the rows, so that none holds more as the table grows.
    spread = narrow.repartition(-(-rows // TASK_ROWS), *keys) if rows > TASK_ROWS else narrow.repartition(*keys)
    names = tuple(sums), tuple(medians)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, BATCH_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(_key_starts(table, keys)[-1])
            if last:
                yield _windows(table.slice(0, last), keys, month, *names, spans)
            held, size = table.slice(last).to_batches(), table.num_rows - last
            enough = max(BATCH_ROWS, 2 * size)
        if size:
            yield _windows(pa.Table.from_batches(held).combine_chunks(), keys, month, *names, spans)

    own = {f.name: f for f in narrow.schema.fields}
    numbers = [StructField(n, DoubleType()) for n in (*sums, *medians)]
    ends = [StructField("end_month", own[month].dataType), StructField("span", IntegerType()), StructField("n", LongType())]
    return spread.sortWithinPartitions(*keys).mapInArrow(run, StructType([*[own[k] for k in keys], *ends, *numbers]))


def _key_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where a new key begins in rows that are sorted by key; NULL is a key."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for key in keys:
        codes = pc.dictionary_encode(_array(table, key), null_encoding="encode").indices.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def _array(table: pa.Table, name: str) -> pa.Array:
    made = table.column(name).combine_chunks()
    return made.chunk(0) if isinstance(made, pa.ChunkedArray) else made


def _numbers(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, which of them are known) of a column of doubles."""
    column = _array(table, name)
    return column.fill_null(0.0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def _windows(table: pa.Table, keys, month, sums, medians, spans) -> pa.RecordBatch:
    """The windows of whole keys, all spans."""
    rows, starts = table.num_rows, _key_starts(table, keys)
    group = np.repeat(np.arange(len(starts)), np.diff([*starts, rows]))
    at = _array(table, month).to_numpy().astype(np.int64)
    # sums are made by month and then by window, in the order of the months
    low, wide = at.min(), at.max() - at.min() + 1
    pieces, piece = np.unique(group * wide + (at - low), return_inverse=True)
    of, month_of = pieces // wide, pieces % wide + low
    added = []
    for name in sums:
        value, known = _numbers(table, f"_s_{name}")
        some = np.bincount(piece[known], minlength=len(pieces)) > 0
        added.append((np.bincount(piece[known], value[known], len(pieces)), some))
    ranked = []
    for name in medians:
        value, known = _numbers(table, f"_v_{name}")
        order = np.argsort(value)  # a value that is not a number comes last
        rank = np.empty(rows, dtype=np.int64)
        rank[order] = np.arange(rows)
        ranked.append((value[order], rank, known))
    out = []
    for span in spans:
        row, end = np.tile(np.arange(rows), span), np.concatenate([at + i for i in range(span)])
        first, width = end.min(), end.max() - end.min() + 1
        found, window = np.unique(group[row] * width + (end - first), return_inverse=True)
        own = {k: _array(table, k).take(pa.array(starts[found // width])) for k in keys}
        own["end_month"] = pa.array(found % width + first).cast(table.schema.field(month).type)
        own["span"] = pa.array(np.full(len(found), span, dtype=np.int32))
        own["n"] = pa.array(np.bincount(window, minlength=len(found)))
        late = np.concatenate([of * width + (month_of + i - first) for i in reversed(range(span))])
        place = np.searchsorted(found, late)
        for name, (value, known) in zip(sums, added):
            inside = np.tile(known, span)
            total = np.bincount(place[inside], np.tile(value, span)[inside], len(found))
            own[name] = pa.array(total, mask=np.bincount(place[inside], minlength=len(found)) == 0)
        for name, (ordered, rank, known) in zip(medians, ranked):
            inside = known[row]
            places = np.sort(window[inside] * rows + rank[row][inside])
            size = np.bincount(window[inside], minlength=len(found))
            before, some = np.cumsum(size) - size, size > 0
            low, high = (ordered[places[(before + middle)[some]] % rows] for middle in ((size - 1) // 2, size // 2))
            made = np.zeros(len(found))
            made[some] = low * 0.5 + high * 0.5
            own[name] = pa.array(made, mask=~some)
        out.append(pa.RecordBatch.from_pydict(own))
    return pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _from_copies(df, keys, month, medians, sums, spans, max_group) -> DataFrame:
    windows = [F.struct(F.lit(a).alias("_ahead"), F.lit(s).alias("span")) for s in spans for a in range(s)]
    rows = df.select("*", F.inline(F.array(*windows))).withColumn("end_month", F.col(month) + F.col("_ahead"))
    totals = [F.count(F.lit(1)).alias("n"), *[F.sum(c).cast("double").alias(n) for n, c in sums.items()]]
    named = {n: (c, 0.5) for n, c in medians.items()}
    made = grouped_percentiles(rows, [*keys, "end_month", "span"], named, totals, max_group)
    return made.select(*keys, "end_month", "span", "n", *sums, *medians)
