import random
import re

import hashlib
import numpy as np
import pytest
import xxhash

from panelkit.llm import components, exact_dedup, simhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def normal(text):
    return re.sub("[\x20\x09-\x0D]+", " ", text or "")


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """Smallest id reachable of every row, by looking at all pairs."""
    prints = [p for _, p in pairs]
    label = list(range(len(pairs)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    ids = {}
    for (i, _), root in zip(pairs, label):
        ids.setdefault(root, []).append(i)
    smallest = {r: min((i for i in own if i is not None), default=None) for r, own in ids.items()}
    return [smallest[r] for r in label]


@pytest.mark.parametrize("runs,fan", [(256, 16), (8, 2), (1, 2)])
def test_classes_equal_grouping_by_text(docs, texts, runs, fan):
    got = exact_dedup.exact_classes(docs, runs=runs, fan=fan).collect()
    groups = {}
    for i, t in texts:
        groups.setdefault(normal(t), []).append(i)
    want = sorted(
        (str(i), str(min((x for x in groups[normal(t)] if x is not None), default=None)), len(groups[normal(t)]),
         hashlib.sha256(normal(t).encode()).hexdigest())
        for i, t in texts
    )
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({w[3] for w in want})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_only_null_ids_and_empty_tables(make, no_docs):
    rows = exact_dedup.exact_classes(make([(None, "a"), (None, "a")])).collect()
    assert [(r.keep_id, r.group_size) for r in rows] == [(None, 2)] * 2 and sum(r.kept for r in rows) == 1
    assert exact_dedup.exact_classes(no_docs).count() == 0 == exact_dedup.drop_copies(no_docs).count()
    assert simhash.simhash_classes(no_docs).count() == 0 == simhash.drop_near_copies(no_docs).count()


def test_drop_copies_keeps_columns_and_one_row_each(docs, texts):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(normal(r.text) for r in rows) == sorted({normal(t) for _, t in texts})
    assert {r.row for r in rows} == {1} and {r.digest for r in rows} == {"d"}


def test_plan_has_no_python_and_no_cross_join(docs):
    plan = exact_dedup.exact_classes(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_fingerprints_and_components_equal_brute_force(docs, texts):
    got = simhash.simhash_classes(docs).collect()
    pairs = [(i, brute_print(t)) for i, t in texts]
    want = zip(pairs, brute_components(pairs))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == sorted(
        (str(i), f"{p:016x}", str(c)) for (i, p), c in want
    )


@pytest.mark.parametrize("bands,block", [(5, 1024), (6, 8), (8, 1024)])
def test_links_of_dense_and_random_fingerprints(spark, bands, block):
    rng = random.Random(7)
    centre = rng.getrandbits(64)
    near = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(150)]
    prints = sorted({*near, *[rng.getrandbits(64) for _ in range(150)], 0, 15, 31})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    table = simhash.add_distances(spark.createDataFrame([(p,) for p in signed], "fp long"))
    edges = simhash.links(table, bands, block=block).collect()
    for e in edges:  # a forest never joins what is not connected
        assert e.a != e.b
    label = {p: p for p in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for e in edges:
        a, b = root(e.a), root(e.b)
        label[max(a, b)] = min(a, b)
    ids = brute_components(list(enumerate(prints)))
    ours = {}
    for i, p in enumerate(signed):
        ours.setdefault(root(p), []).append(i)
    assert sorted(map(sorted, ours.values())) == sorted(
        [i for i, c in enumerate(ids) if c == x] for x in set(ids)
    )


def test_band_count_grows_with_the_table():
    counts = [simhash.band_count(n) for n in (0, 10**4, 10**7, 10**9, 10**12)]
    assert counts == sorted(counts) and counts[0] == 5 and counts[-1] == 8


def test_one_document_of_each_group_stays(make):
    words = [f"w{i}" for i in range(400)]
    base = " ".join(words)
    close = " ".join(words[:399] + ["other"])
    kept = simhash.drop_near_copies(make([(5, base), (3, close), (9, base), (1, "far away text " * 9), (9, base)]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("chunk", [250_000, 40])
def test_components_of_a_path_and_a_star(spark, monkeypatch, chunk):
    monkeypatch.setattr(components, "CHUNK", chunk)
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(path + star + [(7, 7), (3, 2)], "a long, b long")
    got = {(r.node, r.root) for r in components.connected(edges).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(1000 + i, 1000) for i in range(1, 300)}
    assert components.connected(edges.limit(0)).count() == 0
