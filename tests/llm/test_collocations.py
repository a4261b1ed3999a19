"""Stripes against plain counting of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkit.llm import collocations as c

LOWER = {k: k + 32 for k in range(65, 91)}


def plain_pieces(text):
    cut = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [own for own in (re.findall(r"[^\x20\x09]+", p) for p in cut) if own]


def brute(rows, longest, least, top, subsumed=80):
    """rows: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in plain_pieces(text):
            n[lang] += len(piece)
            for k in range(1, longest + 1):
                for i in range(len(piece) - k + 1):
                    f[lang][tuple(piece[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in wanted.items():
            inside = [b for q, b in wanted.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= subsumed * a for b in inside):
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_tokens():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(chr(rng.choice([*range(0, 0x60), 0x85, 0xA0, 0x2028, 0x3042, 0x1F642])) for _ in range(80))
        pieces, own = [], []
        for token in c.tokens_of(text):
            if token == c.MARK:
                pieces += [own] if own else []
                own = []
            else:
                own.append(token.decode())
        assert pieces == plain_pieces(text)


@pytest.mark.parametrize("least,top", [(1, 2000), (2, 7), (30, 2000)])
def test_awkward_rows(docs, texts, least, top):
    rows = [("en", t) for _, t in texts]
    assert got(c.collocations(docs, least=least, top=top)) == brute(rows, 4, least, top)


def test_no_lang_and_empty_tables(docs, no_docs, texts):
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert got(c.collocations(nothing, least=2)) == brute([(None, t) for _, t in texts], 4, 2, 2000)
    assert c.collocations(no_docs).count() == 0


@pytest.fixture(scope="module")
def corpus():
    """One word leads a third of all pairs; set phrases, repeats, and one long text."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    fixed = ["New york city council", "per se", "x x x x", "a b c", "of the"]

    def text(n):
        parts = rng.choices(["hot", *words, *fixed, ".", ";\n", "\t"], weights=[30, *[1] * 60, 4, 3, 2, 3, 5, 5, 2, 2], k=n)
        return " ".join(parts)

    rows = [(rng.choice(["en", "de", None]), text(rng.randint(0, 60))) for _ in range(600)]
    return rows + [("en", text(20_000)), ("en", "y" * 1_000_000)] + rows[:40] * 3


@pytest.mark.parametrize("chunk,parts,bits", [(1 << 23, 1024, 16), (500, 4, 16), (5000, 50, 1)])
def test_all_counts(spark, corpus, monkeypatch, chunk, parts, bits):
    """Also with small chunks, prefixes cut into parts, and a filter that says yes too often."""
    monkeypatch.setattr(c, "CHUNK", chunk)
    monkeypatch.setattr(c, "PARTS", parts)
    monkeypatch.setattr(c, "BITS", bits)
    monkeypatch.setattr(c, "BLOCK_BITS", 64 if bits == 1 else c.BLOCK_BITS)
    table = spark.createDataFrame([(1, l, t, "x") for l, t in corpus], "doc_id long, lang string, text string, phrase string")
    want = brute(corpus, 4, 30, 2000)
    assert len(want) > 60
    assert got(c.collocations(table.repartition(5))) == want


def test_totals_and_parts_of_a_stripe(spark, corpus):
    """A merged stripe's total is the count of its prefix, in every part and over batches."""
    rows = [(l or "und", t) for l, t in corpus[:300]]
    everything = np.full(8, 255, dtype=np.uint8)
    made = [
        c.chunk_stripes(lang, c.tokens_of(text), 3, [everything, everything], {("en", "hot hot"): 5, ("de", "hot w1"): 3})
        for lang, text in rows
        if text
    ]
    stripes = spark.createDataFrame(pa.Table.from_batches(made).to_pylist(), c.STRIPES).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = got(c.merge_stripes(stripes, 1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in plain_pieces(text):
            for k in (2, 3):
                for i in range(len(piece) - k + 1):
                    f[lang][tuple(piece[i : i + k])] += 1
    want = [(lang, " ".join(p[:2]), p[2], a, f[lang][p[:2]]) for lang, own in f.items() for p, a in own.items() if len(p) == 3]
    assert found == sorted(want)


def test_filter_has_no_false_negatives(spark):
    phrases = [("en", f"a{i} b{i % 7}") for i in range(500)]
    bits = c.filter_of(spark.createDataFrame(phrases, "lang string, phrase string"), 2)
    hashes = c.word_hashes([b"en"] * 500)
    for k in (0, 1):
        hashes = c.fold(hashes, c.word_hashes([p.split()[k].encode() for _, p in phrases]))
    assert c.seen(bits, hashes).all()
    others = c.fold(c.word_hashes([b"en"]), c.word_hashes([f"z{i}".encode() for i in range(2000)]))
    assert c.seen(bits, others).mean() < 0.2
