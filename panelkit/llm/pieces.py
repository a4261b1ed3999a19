"""SentencePiece encoding with the N best segmentations, and decoding.

The vocabulary and its order come from a public model file; nothing is trained. The file's
scores are merge ranks, which say nothing when they are added up, so a piece costs the
logarithm of its frequency by rank, -ln(rank + ``RANK_OFFSET``), and a byte more than any
piece. The ids are therefore not those of the library's merges; the best segmentation is about
as short (see the tests). A text, led by one space, is cut into units that no piece crosses: spaces with the characters
after them, and line feeds. On the lattice of a unit the forward Viterbi scores are the
exact cost to the start, so a backward A* search that uses them as its heuristic yields
segmentations from the best on, without a wrong turn. Characters that no piece covers
become their UTF-8 bytes. As the units are independent, the N best segmentations of a
text only differ from the best one in the N - 1 units where a change costs least; a second
best-first search over those gives the exact N best of the whole text.

Results are whole: all ids of the best segmentation, and for each further one its score
and the edits (from, to, ids) that turn the best into it.

Defined results: NULL and empty text have no ids, one segmentation and score 0. Equal
scores are ordered by position, then length, deterministically. Repeated rows are encoded
each, empty tables give no rows, and further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
CACHE = 1 << 20  # units a worker remembers; only a matter of speed
NEVER = -1e8  # scores at or below mark pieces that the model does not mean to be chosen
LONGEST = 48  # longer units are not remembered
RANK_OFFSET = 100.0  # flattens the head of the frequencies by rank
BYTE_COST = 10.0  # of a byte beyond the dearest piece
UNKNOWN = object()  # neither a piece nor the start of one
UNIT = re.compile(r" *[^ \n]+|\n| +")

EDIT = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ids", pa.list_(pa.int32()))])
OTHER = pa.struct([("score", pa.float64()), ("edits", pa.list_(EDIT))])
SCHEMA = (
    "doc_id bigint, ids array<int>, n_pieces bigint, score double, "
    "others array<struct<score:double,edits:array<struct<start:int,end:int,ids:array<int>>>>>, decoded boolean"
)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with plain spaces, ids of the 256 byte pieces, and the score of a byte.

    ``pieces`` also has every prefix of a piece, with None where that is no piece itself.
    """

    pieces: dict[str, tuple[int, float] | None]
    bytes: list[int]
    byte_score: float

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=0)

    def plain(self) -> tuple:
        """Built-in types only, which executors without this package can read."""
        return self.pieces, self.bytes, self.byte_score

    def texts(self) -> list[bytes]:
        out = {x[0]: p.encode() for p, x in self.pieces.items() if x} | {i: bytes([b]) for b, i in enumerate(self.bytes)}
        return [out.get(i, b"") for i in range(max(out) + 1)]


def with_prefixes(pieces: dict[str, tuple[int, float]]) -> dict[str, tuple[int, float] | None]:
    return {p[:k]: None for p in pieces for k in range(1, len(p))} | pieces


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, by_byte = {}, [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = piece.replace("▁", " ")
            if len(UNIT.findall(text)) != 1:
                raise ValueError(f"piece {piece!r} crosses a unit")
            pieces[text] = (i, rank_score(model.get_score(i)))
    # a byte costs more than any merged piece, as an unknown character does in the library
    lowest = min(s for _, s in pieces.values() if s > NEVER)
    return Vocabulary(with_prefixes(pieces), by_byte, lowest - BYTE_COST)


def rank_score(score: float) -> float:
    """Log frequency by rank, up to a constant, from a merge score (minus the rank)."""
    return score if score <= NEVER else -math.log(RANK_OFFSET - min(score, 0.0))


def lattice(unit: str, vocabulary: Vocabulary) -> tuple[list[float], list[list]]:
    """Forward Viterbi score of every position and the arcs (from, score, ids) that end there."""
    pieces, size = vocabulary.pieces, len(unit)
    best = [0.0] + [float("-inf")] * size
    arcs: list[list] = [[] for _ in range(size + 1)]
    for a in range(size):
        reached = best[a]
        for b in range(a + 1, size + 1):
            part = unit[a:b]
            if part not in pieces:
                break
            piece = pieces[part]
            if piece is not None:
                i, score = piece
                arcs[b].append((a, score, (i,)))
                if reached + score > best[b]:
                    best[b] = reached + score
        if pieces.get(unit[a]) is None:
            ids = tuple(vocabulary.bytes[c] for c in unit[a].encode())
            score = vocabulary.byte_score * len(ids)
            arcs[a + 1].append((a, score, ids))
            best[a + 1] = max(best[a + 1], reached + score)
    return best, arcs


def trie_of(vocabulary: Vocabulary) -> dict[str, tuple]:
    """Pieces by character: (what may follow, id or -1, score)."""
    root: dict[str, tuple] = {}
    nodes = {"": root}
    for piece in sorted(vocabulary.pieces, key=len):
        own = vocabulary.pieces[piece]
        i, score = own if own is not None else (-1, 0.0)
        nodes[piece] = {}
        nodes[piece[:-1]][piece[-1]] = (nodes[piece], i, score)
    return root


def first_and_gap(unit: str, vocabulary: Vocabulary, trie: dict[str, tuple] | None = None) -> tuple[float, list[int], float]:
    """Score and ids of the best segmentation and the loss of the second best.

    These are the first steps of the A* search without its heap: walking the best path
    backwards, the search leaves aside the other arcs into each of its positions, and as
    the forward scores are exact, the best of those is the second best segmentation. So
    the forward pass only keeps, for every position, the best arc and the runner-up.
    """
    root, size = trie_of(vocabulary) if trie is None else trie, len(unit)
    reach = vocabulary.longest
    worst = float("-inf")
    best, second, arc = [worst] * (size + 1), [worst] * (size + 1), [None] * (size + 1)
    best[0] = 0.0
    for a in range(size):
        reached, follow, b = best[a], root, a
        for sign in unit[a : a + reach]:
            node = follow.get(sign)
            if node is None:
                break
            follow, i, score = node
            b += 1
            if i >= 0:
                value = reached + score
                if value > best[b]:
                    second[b] = best[b]
                    best[b] = value
                    arc[b] = (a, i)
                elif value > second[b]:
                    second[b] = value
        alone = root.get(unit[a])
        if alone is None or alone[1] < 0:
            ids = [vocabulary.bytes[c] for c in unit[a].encode()]
            value = reached + vocabulary.byte_score * len(ids)
            if value > best[a + 1]:
                second[a + 1], best[a + 1], arc[a + 1] = best[a + 1], value, (a, ids)
            elif value > second[a + 1]:
                second[a + 1] = value
    at, loss, out = size, float("inf"), []
    while at:
        loss = min(loss, best[at] - second[at])
        at, own = arc[at]
        if isinstance(own, list):
            out.extend(reversed(own))
        else:
            out.append(own)
    out.reverse()
    return best[size], out, loss


def n_best(unit: str, vocabulary: Vocabulary, n: int) -> list[tuple[float, list[int]]]:
    """The n best segmentations of a unit, best first, by backward A* search."""
    best, arcs = lattice(unit, vocabulary)
    size = len(unit)
    heap = [(-best[size], 0, size, 0.0, None)]
    made, found = 1, []
    while heap and len(found) < n:
        _, _, at, tail, ids = heapq.heappop(heap)
        if at == 0:
            out = []
            while ids is not None:
                out.extend(ids[0])
                ids = ids[1]
            found.append((tail, out))
            continue
        for a, score, own in arcs[at]:
            heapq.heappush(heap, (-(best[a] + score + tail), made, a, score + tail, (own, ids)))
            made += 1
    return found


def combine(units: list[tuple[int, int, list]], n: int) -> list[tuple[float, list]]:
    """The n best joint changes of several units: (loss, [(start, end, ids), ...]).

    A unit is (start, end, [(loss, ids), ...]) with its alternatives in order of loss.
    """
    heap, seen, out = [(0.0, (0,) * len(units))], {(0,) * len(units)}, []
    while heap and len(out) < n:
        loss, picks = heapq.heappop(heap)
        edits = [(u[0], u[1], u[2][p - 1][1]) for u, p in zip(units, picks) if p]
        out.append((loss, edits))
        for k, p in enumerate(picks):
            if p < len(units[k][2]):
                after = picks[:k] + (p + 1,) + picks[k + 1 :]
                if after not in seen:
                    seen.add(after)
                    before = units[k][2][p - 1][0] if p else 0.0
                    heapq.heappush(heap, (loss - before + units[k][2][p][0], after))
    return out


class Units(dict):
    """ids of the best segmentation of a unit, its score and the loss of the second best.

    Remembers a bounded number of units.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.trie = vocabulary, trie_of(vocabulary)
        self.older: dict[str, tuple[bytes, float, float]] = {}

    def __missing__(self, unit: str) -> tuple[bytes, float, float]:
        made = self.older.get(unit)
        if made is None:
            score, ids, gap = first_and_gap(unit, self.vocabulary, self.trie)
            made = (array("i", ids).tobytes(), score, gap)
        if len(unit) <= LONGEST:
            if len(self) >= CACHE // 2:  # what was not asked for since the last turn is forgotten
                self.older = dict(self)
                self.clear()
            self[unit] = made
        return made


class Encoder:
    """Encodes whole texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        self.vocabulary, self.n, self.units = vocabulary, n, Units(vocabulary)
        self.texts = vocabulary.texts()
        self.known: dict[str, list[tuple[float, bytes]]] = {}

    def changes(self, unit: str, best: bytes) -> list[tuple[float, bytes]]:
        """(loss, ids) of the segmentations of a unit after the best one."""
        made = self.known.get(unit)
        if made is None:
            made = self.changes_of(unit, best)
            if len(unit) <= LONGEST:
                if len(self.known) >= CACHE // 16:
                    self.known.clear()
                self.known[unit] = made
        return made

    def changes_of(self, unit: str, best: bytes) -> list[tuple[float, bytes]]:
        found = [(score, array("i", ids).tobytes()) for score, ids in n_best(unit, self.vocabulary, self.n)]
        return [(found[0][0] - score, ids) for score, ids in found if ids != best][: self.n - 1]

    def encode(self, text: str) -> tuple[np.ndarray, list[tuple[float, list]]]:
        """ids of the best segmentation; (score, edits) of the n best, the best first."""
        if not text:
            return np.zeros(0, dtype=np.int32), [(0.0, [])]
        names = UNIT.findall(" " + text)
        packed, scores, gaps = zip(*map(self.units.__getitem__, names))
        ids = np.frombuffer(b"".join(packed), dtype=np.int32)
        score = sum(scores)
        few = np.argsort(np.array(gaps), kind="stable")[: self.n - 1]
        ends = np.cumsum(np.fromiter(map(len, packed), dtype=np.int64, count=len(packed))) // 4
        cheap = [
            (int(ends[k]) - len(packed[k]) // 4, int(ends[k]), self.changes(names[k], packed[k]))
            for k in sorted(few.tolist())
            if gaps[k] < np.inf
        ]
        return ids, [(score - loss, edits) for loss, edits in combine(cheap, self.n)]

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.texts.__getitem__, ids.tolist()))
        return joined[1:].decode("utf-8", "replace")


def apply(ids: np.ndarray, edits: list) -> np.ndarray:
    """The segmentation that ``edits`` make of the best one."""
    parts, at = [], 0
    for start, end, own in edits:
        parts += [ids[at:start], np.frombuffer(own, dtype=np.int32)]
        at = end
    return np.concatenate([*parts, ids[at:]])


def encode(docs: DataFrame, model: str = MODEL, n: int = N_BEST) -> DataFrame:
    """One row per document: ids, score and the further best segmentations, read back."""
    # what a worker makes of the broadcast stays with it, and with it the remembered units
    shared = docs.sparkSession.sparkContext.broadcast({"plain": load(model).plain()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        encoder = own["encoder"] = own.get("encoder") or Encoder(Vocabulary(*own["plain"]), n)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                made = [encoder.encode(t) for t in texts]
                sizes = [len(ids) for ids, _ in made]
                offsets = pa.array(np.cumsum([0, *sizes]), type=pa.int32())
                values = np.concatenate([ids for ids, _ in made])
                others = [
                    [
                        {"score": s, "edits": [{"start": a, "end": b, "ids": np.frombuffer(i, dtype=np.int32)} for a, b, i in e]}
                        for s, e in best[1:]
                    ]
                    for _, best in made
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(offsets, pa.array(values, type=pa.int32())),
                        pa.array(sizes, type=pa.int64()),
                        pa.array([best[0][0] for _, best in made], type=pa.float64()),
                        pa.array(others, type=pa.list_(OTHER)),
                        pa.array([encoder.decode(ids) == t for (ids, _), t in zip(made, texts)]),
                    ],
                    names=["doc_id", "ids", "n_pieces", "score", "others", "decoded"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text of rows with ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(model).plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value), 1)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            texts = [encoder.decode(np.array(ids or [], dtype=np.int32)) for ids in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
