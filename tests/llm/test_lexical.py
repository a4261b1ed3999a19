"""Dual-tree search against plain Python over all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from panelkit.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    words = [plain_terms(t) for _, t in docs]
    n_docs, total = sum(1 for w in words if w), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), own in zip(docs, words):
            tf, score = Counter(own), 0
            m = 75 + (25 * len(own) * n_docs) // total if total else 0
            for t in plain_terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, known, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item_id, rank, doc_id if known else None, -score))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "alpha beta BETA mu"), (2, None), (3, ""), (4, "of the end"), (5, "漢字 łetters ŁETTERS"), (4, "of the end"),
            (None, "two one"), (6, "nowhere at all"), (7, "-- !!")]
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, doc_id string, score int")


def test_terms_are_those_of_the_pattern():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(chr(rng.choice([*range(0, 0x180), 0x2028, 0x3042, 0x1F642])) for _ in range(60))
        assert [t.decode() for t in lexical.terms_of(text)] == plain_terms(text)
    assert lexical.terms_of(None) == lexical.terms_of("") == []


@pytest.mark.parametrize("k", [1, 3, 20])
def test_awkward_rows(docs, texts, items, k):
    rows, table = items
    assert got(lexical.rank_documents(docs, table, k)) == brute(texts, rows, k)


def test_empty_tables(docs, no_docs, items):
    _, table = items
    assert lexical.rank_documents(no_docs, table).count() == 0
    assert lexical.rank_documents(docs, table.limit(0)).count() == 0


@pytest.fixture(scope="module")
def corpus():
    """Two languages, common and rare words, copies, and one very long text."""
    rng = random.Random(11)
    words = [[f"{a}{i}" for i in range(300)] for a in "xy"]
    text = lambda side, n: " ".join(words[side][int(300 * rng.random() ** 3)] for _ in range(n))
    docs = [(i, text(i % 2, rng.randint(1, 60))) for i in range(900)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(5000, text(0, 200_000)), (5001, "z" * 1_000_000)]
    items = [(i, text(i % 2, rng.randint(1, 25))) for i in range(90)] + [(90, docs[7][1]), (91, "z" * 1_000_000)]
    return docs, items


@pytest.mark.parametrize("cells", [None, 4000])
def test_all_rows_of_a_corpus(spark, make, corpus, monkeypatch, cells):
    """Also with many small blocks of items and small trees."""
    docs, items = corpus
    if cells:
        monkeypatch.setattr(lexical, "CELLS", cells)
    table = spark.createDataFrame(items, "item_id long, text string")
    found = lexical.rank_documents(make(docs).repartition(5), table)
    assert got(found) == brute(docs, items, 20)


def test_node_pairs_are_left_out():
    """The search returns the best of all pairs and scores a part of them."""
    rng = np.random.default_rng(3)
    matrix = np.where(rng.random((64, 400)) < 0.03, rng.integers(1, 9, (64, 400)) * 1000, 0)
    values = np.where(rng.random((4000, 400)) < 0.005, rng.integers(1, 1000, (4000, 400)), 0)
    values[:, 0] = matrix[:, 0] = 1
    owner, terms = np.nonzero(values)
    scores, ids, parts = matrix @ values.T, np.arange(4000), []
    for floors in (np.zeros(64, dtype=np.int64), np.sort(scores, axis=1)[:, -5]):
        items = lexical.Items(matrix, floors, 5)
        docs = lexical.Documents(ids, ids >= 0, owner, terms, values[owner, terms], np.ones(400, dtype=np.int64))
        parts.append(lexical.search(items, docs) / scores.size)
        for place, item in enumerate(items.order):
            order = np.lexsort((ids, -scores[item]))[:5]
            assert items.best[place][2].tolist() == order.tolist()
            assert items.best[place][0].tolist() == scores[item][order].tolist()
    assert parts[1] < parts[0] < 0.5
