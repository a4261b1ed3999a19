"""Byte-level BPE encoding and decoding with a rank queue on a hierarchical bitmap.

A text is cut by the tokenizer's pattern into pre-tokens, and each is merged by itself. The
parts of a pre-token form a linked list. A bucket per merge rank holds the positions where
a pair of that rank began when it was seen; a bitmap marks the buckets that have entries,
and a second one on top marks the words of the first that are not zero. Two find-first-set
steps so name the lowest rank of all, whatever the length of the pre-token, and the
bucket's smallest position is merged next. An entry whose pair has changed since is stale
and skipped. A pre-token of n bytes costs O(n log n) steps and about 250 bytes of memory
per byte while it is merged; results are those of repeated merging of the leftmost pair
of the lowest rank.

Pre-tokens are remembered by the Python worker (up to ``MEMORY``; only a matter of speed).
Texts pass through no shuffle, and one text at a time is cut into pre-tokens, very long
ones in runs of ``RUN`` matches.

Defined results: NULL and empty text have no ids and decode to no bytes. Repeated rows are
encoded each, equal texts get equal ids (there are no ties), empty tables give no rows,
and further columns are ignored. Whole texts are encoded, however long they or their
words are. Ids outside the vocabulary decode to no bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMORY = 1 << 20  # pre-tokens a worker remembers
REMEMBERED = 64  # longer pre-tokens are not remembered
RUN = 1 << 16  # matches of a very long text that are held at a time
LONG = 1 << 20  # characters from which a text counts as very long
SHIFT = 8  # the lower bitmap has words of 2^SHIFT ranks
MASK = (1 << SHIFT) - 1

ENCODED = "doc_id bigint, ids array<int>, n_tokens bigint"
DECODED = "doc_id bigint, ids array<int>, n_tokens bigint, bytes binary"


def load(path: str = MODEL) -> dict[bytes, int]:
    """Token bytes and their merge rank, from lines of base64 and rank."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


def pair_table(ranks: dict[bytes, int]) -> list[int | None]:
    """Rank of every pair of bytes, by 256 times the first plus the second."""
    return [ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], pairs: list[int | None] | None = None) -> list[int]:
    """Ids of one pre-token."""
    if piece in ranks:
        return [ranks[piece]]
    get, size = ranks.get, len(piece)
    pairs = pair_table(ranks) if pairs is None else pairs
    ends = list(range(1, size + 1))  # where the part that starts here ends, and so the next one starts
    before = list(range(-1, size - 1))  # where the part before starts
    pair = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of the pair that starts here
    pair.append(None)
    top, words, buckets = 0, {}, {}
    for at, rank in enumerate(pair):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(at)
            else:
                buckets[rank] = [at]
                word = rank >> SHIFT
                words[word] = words.get(word, 0) | 1 << (rank & MASK)
                top |= 1 << word
    while top:
        word = (top & -top).bit_length() - 1
        bits = words[word]
        first = bits & -bits
        rank = (word << SHIFT) + first.bit_length() - 1
        bucket = buckets[rank]
        at = heappop(bucket) if len(bucket) > 1 else bucket.pop()
        if not bucket:
            words[word] = bits = bits ^ first
            if not bits:
                top ^= 1 << word
        if pair[at] != rank:
            continue  # stale
        middle = ends[at]
        end = ends[middle]
        ends[at] = end
        pair[middle] = pair[at] = None
        left = before[at]
        if end < size:
            before[end] = at
            rank = get(piece[at : ends[end]])
            if rank is not None:
                pair[at] = rank
                bucket = buckets.get(rank)
                if bucket:
                    heappush(bucket, at)
                else:
                    buckets[rank] = [at]
                    word = rank >> SHIFT
                    words[word] = words.get(word, 0) | 1 << (rank & MASK)
                    top |= 1 << word
        if left >= 0:
            rank = pair[left] = get(piece[left:end])
            if rank is not None:
                bucket = buckets.get(rank)
                if bucket:
                    heappush(bucket, left)
                else:
                    buckets[rank] = [left]
                    word = rank >> SHIFT
                    words[word] = words.get(word, 0) | 1 << (rank & MASK)
                    top |= 1 << word
    out, at = [], 0
    while at < size:
        end = ends[at]
        out.append(ranks[piece[at:end]])
        at = end
    return out


class Pieces(dict):
    """Packed ids of a pre-token; remembers a bounded number of them."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.pairs = ranks, pair_table(ranks)

    def __missing__(self, name: str) -> bytes:
        packed = array("i", merge(name.encode(), self.ranks, self.pairs)).tobytes()
        if len(name) <= REMEMBERED:
            if len(self) >= MEMORY:
                self.clear()
            self[name] = packed
        return packed


class Encoder:
    """Encodes whole texts with one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.pieces, self.pattern = Pieces(ranks), regex.compile(pattern)

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        if len(text) < LONG:
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))
        found, parts = self.pattern.finditer(text), []
        while part := [m[0] for m in islice(found, RUN)]:
            parts.append(b"".join(map(self.pieces.__getitem__, part)))
        return b"".join(parts)


def token_texts(ranks: dict[bytes, int]) -> list[bytes]:
    texts = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        texts[rank] = token
    return texts


def sliced(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few rows, so that long values do not meet in one."""
    for batch in batches:
        rows = max(1, min(1024, batch.num_rows * most // max(1, batch.column(column).nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def decoded(lists: pa.ListArray, texts: list[bytes]) -> pa.Array:
    """The bytes that each list of ids stands for."""
    ids = lists.flatten().fill_null(-1).to_numpy()
    ends = [0, *np.cumsum(pc.list_value_length(lists).fill_null(0)).tolist()]
    made = []
    for start, end in pairwise(ends):
        own = ids[start:end]
        if own.size and (own.min() < 0 or own.max() >= len(texts)):
            own = own[(own >= 0) & (own < len(texts))]
        made.append(b"".join(map(texts.__getitem__, own.tolist())))
    return pa.array(made, type=pa.binary())


def encode(docs: DataFrame, model: str = MODEL, pattern: str = PATTERN, read_back: bool = False) -> DataFrame:
    """One row per document: doc_id, ids and their number.

    With ``read_back`` also the bytes that the ids decode to, made from the ids by the same
    worker: what ``decode`` would add, without moving the ids once more.
    """
    # what a worker makes of the broadcast stays with it, and with it the remembered pre-tokens
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": load(model)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        if "encoder" not in own:
            own["encoder"], own["texts"] = Encoder(own["ranks"], pattern), token_texts(own["ranks"])
        encoder = own["encoder"]
        for part in sliced(batches, 1, 1 << 22):
            packed = [encoder.encode(t or "") for t in part.column(1).to_pylist()]
            sizes = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            ids = pa.Array.from_buffers(pa.int32(), int(sizes.sum()), [None, pa.py_buffer(b"".join(packed))])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), type=pa.int32()), ids)
            made = {"doc_id": part.column(0), "ids": lists, "n_tokens": pa.array(sizes)}
            if read_back:
                made["bytes"] = decoded(lists, own["texts"])
            yield pa.RecordBatch.from_pydict(made)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, DECODED if read_back else ENCODED)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Rows of ``encode`` with the bytes that their ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(token_texts(load(model)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, 1, 1 << 22):
            columns = [*part.columns, decoded(part.column(1), shared.value)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_tokens", "bytes"])

    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(run, DECODED)


def decimal(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
