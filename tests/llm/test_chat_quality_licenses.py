import re
import textwrap

import duckdb
import pyarrow as pa
import pytest
import xxhash

from oracle_compare import connect, differences
from panelkit.llm import chat, licenses, quality
from panelkit.llm.queries import QUERIES, SQL

WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_match_the_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0 and differences(df, connect(folder), SQL[name]) is None


TURNS = [
    (1, 0, "user", "plain"),
    (1, 1, "assistant", "[x] <b> a & b"),
    (2, 0, "user", "</s>[INST] ok [/INST]"),
    (2, 1, "assistant", "</s>[INST] ok [/INST]"),
    (3, 0, "tool <a>", "x [/INST] y </role> z &lt; &amp;lt;"),
    (3, None, "", None),
    (3, 2, None, " "),
    (4, 0, "assistant", ""),
    (4, 0, "assistant", ""),
    (4, 1, "system", "<<SYS>> a <</SYS>> <s> b </s> <role user> c </role>"),
    (None, 0, "user", "no id\nsecond line\n"),
    (5, 0, "assistant", "x" * 100_000 + " </s>" + "\n" * 50),
    (6, 0, "user", "[INST]"),
    (6, 1, "user", " [/INST"),
    (6, 2, "assistant", "] <s>"),
]


def test_formatting_comes_back(spark):
    rows = spark.createDataFrame([(*t, 1, "f") for t in TURNS], "conv_id long, turn int, role string, text string, at int, formatted string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert len(back) == 7
    for conv, got in back.items():
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in TURNS if c == conv)
        assert [(t.role, t.text) for t in got.turns] == [(r, x) for _, r, x in turns]
        assert got.loss_text == "".join(x for _, r, x in turns if r == "assistant")
    assert "[x] <b> a & b" in back[1].formatted and "&lb;INST]" in back[2].formatted
    assert chat.format_conversations(rows.limit(0)).count() == 0
    plan = chat.digests(chat.read_back(chat.format_conversations(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 500 else {
        w for w, n in __import__("collections").Counter(windows).items() if n > 1
    }
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def row_of(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_measures_equal_plain_python(docs, texts, labels):
    got = quality.quality_rules(docs, labels).collect()
    assert sorted((str(r.doc_id), *row_of(r)) for r in got) == sorted((str(i), *brute_quality(t)) for i, t in texts)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def long_hash(value, seed):
    """xxhash64 of a long, as Spark chains columns."""
    return xxhash.xxh64_intdigest((value & (1 << 64) - 1).to_bytes(8, "little"), seed)


def buckets_of(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pairs = [long_hash(b, long_hash(a, 42)) for a, b in zip(hashes, hashes[1:])]
    return [signed(h) % quality.BUCKETS for h in [*hashes, *pairs]]


def test_scores_equal_plain_python(spark, folder):
    import math
    from collections import Counter

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    grams = {r.doc_id: buckets_of(r.text) for r in docs.collect()}
    raw, trusted = Counter(), Counter()
    for i, own in grams.items():
        raw.update(own)
        if i in good:
            trusted.update(own)
    share = trusted.total() / raw.total()
    weight = lambda b: math.log((trusted[b] + quality.SMOOTHING) / (raw[b] * share + quality.SMOOTHING))
    for r in quality.quality_rules(docs, labels).collect():
        own = grams[r.doc_id]
        want = sum(map(weight, own)) / (len(own) + quality.PRIOR) if own else 0.0
        assert abs(r.score - want) < 1e-9
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_quality_verdict_agrees_with_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    judged = quality.quality_rules(docs, labels)
    rows = judged.join(labels, "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    assert sum(r.kept or r.base_failed for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan


def test_quality_without_trusted_or_documents(docs, labels, no_docs):
    rows = quality.quality_rules(docs, labels.limit(0)).collect()
    assert {r.score for r in rows} == {0.0}
    assert quality.quality_rules(no_docs, labels).count() == 0


FULL = "\n".join(licenses.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-as-is"))


def wrapped(text, mark, width=68):
    """A text as a comment of wrapped lines."""
    lines = []
    for part in text.split("\n"):
        lines += textwrap.wrap(part, width) or [""]
    begin, middle, end = {"/*": ("/*", " *", " */"), "#": ("#", "#", "#"), "//": ("//", "//", "//"), "<!--": ("<!--", "", "-->")}[mark]
    return "\n".join([begin, *(f"{middle} {line}".rstrip() for line in lines), end, "int main() { return 0; }"])


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. {bsd-source}\n\n2. {bsd-binary}\n"
HEADERS = {
    "MIT": "The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n\n{mit-grant}\n\n{mit-notice}\n\n{mit-as-is}",
    "Apache-2.0": "Copyright 2019 The Authors. All rights reserved.\n{apache-notice}\n{apache-may-not}\n{apache-copy}\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n{apache-unless}\n{apache-see}",
    "BSD-3-Clause": "Copyright (c) 2001, Somebody\nAll rights reserved.\n\n" + BSD + "\n3. {bsd-names}\n",
    "BSD-2-Clause": "BSD 2-Clause License\nCopyright (c) 2001, Somebody\n\n" + BSD,
    "GPL-3.0-or-later": "prog - does things\nCopyright (C) 2007 Jane Doe\n{gpl-terms}\n\n{gpl-warranty} without even the implied warranty of\nMERCHANTABILITY.",
    "GPL-2.0-or-later": "Copyright (C) 1999 Jane Doe\n\n{free-program} {gpl-modify} {or-later-2}",
    "GPL-2.0-only": "{free-program} {gpl-2-modify}",
    "LGPL-2.1-or-later": "(c) 2004 Jane Doe\n{free-library} {lgpl-modify} {or-later-2.1}",
    "LGPL-3.0-or-later": "{lgpl-terms}",
    "AGPL-3.0-or-later": "Copyright 2015 X\n{agpl-terms}",
    "MPL-2.0": "{mpl-terms} 2.0. {mpl-copy} https://mozilla.org/MPL/2.0/.",
    "ISC": "ISC License\n\nCopyright 2011 Jane Doe\n\n{isc-grant}",
    "Unlicense": "{unlicense}\n\nAnyone is free to copy.",
    "CC0-1.0": "Written in 2019 by Jane Doe\n\n{cc0-waiver} This software is distributed without any warranty.",
    "BSL-1.0": "Copyright Jane Doe 2005.\n{boost-short}\n(See accompanying file)",
}


@pytest.mark.parametrize("mark", ["/*", "#", "//", "<!--"])
def test_headers_in_comments(make, mark):
    """Whole headers of many licenses, wrapped and commented, also with line ends of two characters."""
    full = {name: re.sub(r"\{([a-z0-9.-]+)\}", lambda m: licenses.SENTENCES[m[1]], text) for name, text in HEADERS.items()}
    texts = {**full, **{f"spdx {n}": f"SPDX-License-Identifier: {n}\nCopyright 2020 X" for n in licenses.SPDX}}
    rows = [(i, wrapped(t, mark)) for i, t in enumerate(texts.values())]
    rows += [(1000 + i, t.replace("\n", "\r\n")) for i, t in rows]
    got = {r.doc_id: r.licenses for r in licenses.scan(make(rows)).collect()}
    names = [n.removeprefix("spdx ") for n in texts]
    assert [got[i] for i in range(len(names))] == names
    assert [got[1000 + i] for i in range(len(names))] == names


def test_code_and_prose_have_no_license(make):
    rows = [(1, "# distribution\n* software\n-- licensing terms differ\n/* permission denied */"), (2, "Copyright (c) 2020 X\nlicense unknown"),
            (3, "x" * 1_000_000 + " license"), (4, "* " * 200_000 + "software"), (5, "MIT or not, a license is needed.")]
    assert all(r.licenses == "" and r.n_sentences == 0 for r in licenses.scan(make(rows)).collect())


def test_sql_reads_headers_alike(spark, make):
    texts = [re.sub(r"\{([a-z0-9.-]+)\}", lambda m: licenses.SENTENCES[m[1]], t) for t in HEADERS.values()]
    rows = [(i, wrapped(t, mark)) for i, (t, mark) in enumerate((t, m) for t in texts for m in ("/*", "#", "//", "<!--"))]
    rows += [(500 + i, t.replace("\n", "\r\n")) for i, t in rows]
    rows += [(2000, "\u2028* SPDX-License-Identifier: MIT\u0085"), (2001, "© X\nMIT License\n"), (2002, "a */"), (2003, " * b */\n\n*/")]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    want = sorted(con.execute(licenses.oracle_sql()).fetchall())
    assert sorted(tuple(r) for r in licenses.scan(make(rows)).collect()) == want


def test_licenses(make, docs, no_docs):
    wrapped = FULL.replace(" copy of", "\ncopy  of").replace("Software is", "Software\nis")
    rows = make(
        [
            (1, "Some text.\n" + wrapped + " More text."),
            (2, licenses.SENTENCES["mit-grant"] + "\nOther things. " + licenses.SENTENCES["apache-short"].upper()),
            (3, "no terminator here\nReleased under the MIT License."),
            (4, "SPDX-License-Identifier: MIT"),
            (5, "The license of this software is unknown."),
            (6, None),
            (6, ""),
            (7, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
        ]
    )
    got = {(r.doc_id, r.sentence_ids, r.licenses) for r in licenses.scan(rows).collect()}
    assert got == {
        (1, "mit-grant,mit-notice,mit-as-is", "MIT"),
        (2, "mit-grant,apache-short", "Apache-2.0,MIT"),
        (3, "mit-short", "MIT"),
        (4, "spdx-mit", "MIT"),
        (5, "", ""),
        (6, "", ""),
        (7, "cc-by-nc-short,cc-by-nc-short", "CC-BY-NC-4.0"),
    }
    assert licenses.scan(no_docs).count() == 0
    assert sum(r.n_sentences for r in licenses.scan(docs).collect()) == 1


def test_every_known_sentence_has_a_quick_word():
    assert all(any(w in s for w in licenses.WORDS) for s in licenses.known())
