import corpus_pipeline
from panelkit.llm import packing, secrets

from test_exact_and_near import brute_components, brute_print, normal
from test_language_and_secrets import brute_spans


def test_stages_keep_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = [docs.count()]
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[1] >= 0.99 * counts[0] > counts[2] and counts[3] == counts[4] <= counts[2]
    assert secrets.find_secrets(docs).filter("size(spans) > 0").count() == 0
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len({r.doc_id for r in rows}) == counts[4]
    assert all(r.n_tokens <= packing.CONTEXT for r in rows)


def test_awkward_and_empty_tables(spark, docs, no_docs, folder, texts):
    """NULL and letterless texts go, of equal texts one row stays, further columns are kept."""
    table = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        table = step(spark, table, folder)
        assert table.columns == docs.columns, name
    rows = table.collect()
    assert all(r.text and any(c.isalpha() for c in r.text) and r.whole == "w" for r in rows)
    kept = [normal(r.text) for r in rows]
    assert len(set(kept)) == len(kept)
    known = {i for i, t in texts if t and any(c.isalpha() for c in t)}
    assert {r.doc_id for r in rows} <= known and len(rows) >= 5
    table = no_docs
    for _, step in corpus_pipeline.STAGES:
        table = step(spark, table, folder)
    assert table.count() == 0


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "secret_scan", "packing"]


def test_stages_equal_a_brute_force_version(spark):
    """Ids and texts before packing, on documents of which the model rejects none."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i in sorted(texts):
        first.setdefault(normal(texts[i]), i)
    alone = sorted(first.values())
    near = brute_components([(i, brute_print(texts[i])) for i in alone])
    want = sorted({i for i, c in zip(alone, near) if i == c})
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(got) == want
    assert all(got[i] == texts[i] or brute_spans(texts[i]) for i in want)
    rows = corpus_pipeline.run(spark, folder).collect()
    tokens = {}
    for r in rows:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.n_tokens
    assert tokens == {i: len(t.encode()) + 1 for i, t in got.items()}
