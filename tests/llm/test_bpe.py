"""Byte-level BPE against the library, the definition and an exact round trip."""

import hashlib
import random

import numpy as np
import pytest

from panelkit.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load()


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks)


def ids_of(encoder, text):
    return np.frombuffer(encoder.encode(text), dtype=np.int32).tolist()


def plain(piece, ranks):
    """Repeated merging of the leftmost pair of the lowest rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        _, at = min(found)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def test_merge_is_the_definition_on_random_vocabularies():
    """Ranks out of order too, where a merge may make a pair of a lower rank."""
    rng = random.Random(3)
    for _ in range(300):
        tokens = {bytes([c]) for c in range(97, 101)}
        for _ in range(rng.randint(0, 25)):
            tokens.add(b"".join(rng.choices(sorted(tokens), k=2)))
        order = sorted(tokens)
        rng.shuffle(order)
        own = {t: r * rng.choice([1, 300]) for r, t in enumerate(order)}
        if len(set(own.values())) < len(own):
            own = {t: r for r, t in enumerate(order)}
        for _ in range(10):
            piece = bytes(rng.choices(range(97, 101), k=rng.randint(1, 40)))
            want = [own[piece]] if piece in own else plain(piece, own)
            assert bpe.merge(piece, own) == want


def test_every_code_point_as_the_library(encoder, library):
    rng = random.Random(5)
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + rng.sample(range(0xE000, 0x110000), 2000)
    for at in range(0, len(points), 50):
        text = "a".join(f"{chr(c)}1 " for c in points[at : at + 50])
        assert ids_of(encoder, text) == library.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["", " ", "\n\n  x", "it's we'll I'd", "<|endoftext|>", "漢字かな 🙂🙂", "a" * 70_000, "ab" * 40_000, "🙂" * 9_000, " " * 50_000 + "x", "Zq" * 30_000 + " 12345" * 2_000],
    ids=range(11),
)
def test_long_and_odd_texts_as_the_library(encoder, library, text):
    assert ids_of(encoder, text) == library.encode_ordinary(text)


def test_a_megabyte_in_runs(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "RUN", 1000)
    words = random.Random(7).choices(["the", " of", " naïve", "\n", " 2024", "x" * 50, "漢"], k=bpe.LONG // 2)
    text = "".join(words)
    assert len(text) > bpe.LONG
    assert ids_of(encoder, text) == library.encode_ordinary(text)


def test_memory_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    encoder = bpe.Encoder(ranks)
    text = "one two three fourfold fivefold sixfold one two"
    assert ids_of(encoder, text) == library.encode_ordinary(text)
    assert len(encoder.pieces) <= 3


def test_rows(docs, no_docs, texts, library):
    rows = bpe.decode(bpe.encode(docs)).collect()
    want = sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in texts), key=repr)
    assert sorted(((r.doc_id, r.ids, bytes(r.bytes)) for r in rows), key=repr) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert bpe.decode(bpe.encode(no_docs)).count() == 0
    again = bpe.encode(docs, read_back=True).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows)) and bpe.encode(no_docs, read_back=True).count() == 0


def test_ids_outside_the_vocabulary(spark):
    rows = spark.createDataFrame([(1, [64, -5, 10**6, None], 4), (2, None, None), (3, [], 0)], bpe.ENCODED)
    got = {r.doc_id: bytes(r.bytes) for r in bpe.decode(rows).collect()}
    texts = bpe.token_texts(bpe.load())
    assert got == {1: texts[64], 2: b"", 3: b""}


def test_query_digests(spark, folder, library):
    from panelkit.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op11_bitmap_rank_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
