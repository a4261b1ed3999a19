"""License scans by sentence rules.

Comment marks at the beginning and end of lines are taken off first. A text is then cut into
sentences: at white space after ``. ! ? ;``, at a line end after a colon, at blank lines, and
around copyright lines and headings that name a license. Each sentence, and each line of a sentence that spans several, is normalised (lower case, all
but a-z and 0-9 to single spaces) and looked up among the known license sentences. What is
recognised gives the document's sequence of identifiers. Rules are ordered: the first rule
takes every place where its identifiers follow each other in the sequence, the next one
what is left, so a full text comes before a notice that quotes part of it.

All steps are expressions of one row, without a shuffle; texts without any of the words
that every known sentence has at least one of are not cut up.

Defined results: NULL and empty texts have no sentences. Texts of any length are scanned whole.
Repeated rows are scanned each, empty tables give no rows, further columns are ignored; there
are no ties, because rules are ordered. U+0001 in a text ends a sentence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import let

# Sentences of public license texts and of the notices that name them.
SENTENCES = {
    "apache-notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-may-not": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-unless": (
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "mit-as-is": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "mit-short": "Released under the MIT License.",
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "gpl-terms": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "gpl-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "free-program": "This program is free software;",
    "free-library": "This library is free software;",
    "gpl-modify": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation;"
    ),
    "gpl-2-modify": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the "
        "Free Software Foundation."
    ),
    "lgpl-modify": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation;"
    ),
    "or-later-2": "either version 2 of the License, or (at your option) any later version.",
    "or-later-2.1": "either version 2.1 of the License, or (at your option) any later version.",
    "or-later-3": "either version 3 of the License, or (at your option) any later version.",
    "agpl-terms": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "lgpl-terms": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at",
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0-waiver": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this "
        "software to the public domain worldwide."
    ),
    "boost-short": "Distributed under the Boost Software License, Version 1.0.",
    "gpl-short": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-short": "Licensed under CC BY-SA 4.0.",
}
# Names that a line with an SPDX identifier may carry.
SPDX = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "BSL-1.0", "Unlicense", "WTFPL",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later",
    "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "Artistic-2.0",
    "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Python-2.0", "PostgreSQL", "OFL-1.1",
)
SENTENCES |= {f"spdx-{name.lower()}": f"SPDX-License-Identifier: {name}" for name in SPDX}
# SPDX names and the sentences that must follow each other, first rule first.
RULES = (
    ("Apache-2.0", ("apache-notice", "apache-may-not", "apache-copy", "apache-unless", "apache-see")),
    ("Apache-2.0", ("apache-notice", "apache-may-not")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-grant",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("AGPL-3.0-or-later", ("agpl-terms",)),
    ("LGPL-3.0-or-later", ("lgpl-terms",)),
    ("GPL-2.0-or-later", ("free-program", "gpl-modify", "or-later-2")),
    ("GPL-3.0-or-later", ("free-program", "gpl-modify", "or-later-3")),
    ("GPL-2.0-only", ("free-program", "gpl-2-modify")),
    ("LGPL-2.1-or-later", ("free-library", "lgpl-modify", "or-later-2.1")),
    ("LGPL-3.0-or-later", ("free-library", "lgpl-modify", "or-later-3")),
    ("MPL-2.0", ("mpl-terms", "mpl-copy")),
    ("MPL-2.0", ("mpl-terms",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("BSL-1.0", ("boost-short",)),
    ("GPL-3.0-or-later", ("gpl-terms", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-terms",)),
    ("Apache-2.0", ("apache-short",)),
    ("MIT", ("mit-short",)),
    ("GPL-3.0-only", ("gpl-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-short",)),
    ("CC-BY-4.0", ("cc-by-short",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-short",)),
    *((name, (f"spdx-{name.lower()}",)) for name in SPDX),
)
# Every normalised sentence has one of these, see the tests.
WORDS = ("licens", "permission", "software", "redistribution", "distribut")
# Both pattern engines read these alike: no line anchors and no look-around. (pattern, groups kept)
COMMENT = "(^|\n)[\\x20\\x09]*(?:/\\*+|\\*+/|\\*+|//+|#+|--+|;;+|%+|<!--+)[\\x20\\x09]*"
COMMENT_END = "[\\x20\\x09]*(?:\\*+/|--+>)[\\x20\\x09\\x0D]*(\n|\\z)"
COPYRIGHT = "(^|\n)[\\x20\\x09]*((?:Copyright|\\([cC]\\)|\u00a9|All rights reserved)[^\n]*)"
HEADING = "(^|\n)[\\x20\\x09]*((?i:the )?(?i:mit|isc|bsd|new bsd|modified bsd|simplified bsd|boost)\\b[^\n.;:]{0,40}(?i:licen[cs]e)[^\n.;:]{0,20})(\n|\\z)"
STEPS = ((COMMENT, (1,)), (COMMENT_END, (1,)), (COPYRIGHT, (1, "\u0001", 2, "\u0001")), (HEADING, (1, "\u0001", 2, "\u0001", 3)))
SENTENCE_END = "([.!?;])[\\x20\\x09-\\x0D]+|(:)[\\x20\\x09\\x0D]*\n[\\x20\\x09-\\x0D]*"


def plain(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def known(sentences: dict[str, str] = SENTENCES) -> dict[str, str]:
    """identifier of every normalised sentence; a sentence with inner ends is cut as texts are."""
    out = {}
    for name, text in sentences.items():
        parts = [p for p in (plain(x) for x in re.split(r"(?<=[.!?;])\s+", text)) if p]
        if len(parts) == 1:
            out[parts[0]] = name
        else:
            raise ValueError(f"{name} is more than one sentence")
    return out


def sentences_of(text: Column) -> Column:
    """Normalised sentences and, after each that spans lines, its lines."""
    for pattern, kept in STEPS:
        text = F.regexp_replace(text, pattern, "".join(f"${k}" if isinstance(k, int) else k for k in kept))
    ended = F.regexp_replace(text, SENTENCE_END, "$1$2\u0001")
    units = F.split(ended, "\u0001|\n[\\x20\\x09-\\x0D]*\n")

    def with_lines(unit: Column) -> Column:
        return F.when(F.contains(unit, F.lit("\n")), F.concat(F.array(unit), F.split(unit, "\n"))).otherwise(F.array(unit))

    return F.transform(
        F.flatten(F.transform(units, with_lines)), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " "))
    )


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per document: doc_id, n_sentences, sentence_ids, licenses."""
    lookup = known(sentences)
    table = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    text = F.coalesce("text", F.lit(""))
    lower = F.lower(text)
    likely = F.lit(False)
    for word in WORDS:
        likely = likely | F.contains(lower, F.lit(word))
    listed = F.array(*[F.lit(s) for s in lookup])
    hits = F.filter(sentences_of(text), lambda s: F.array_contains(listed, s))
    names = F.transform(hits, lambda s: F.element_at(table, s))
    found = docs.select("doc_id", F.when(likely, names).otherwise(F.array().cast("array<string>")).alias("names"))
    taken = F.array_join(F.transform("names", lambda n: F.concat(F.lit("<"), n, F.lit(">"))), "")
    for spdx, parts in rules:
        taken = F.replace(taken, F.lit("".join(f"<{p}>" for p in parts)), F.lit(f"[{spdx}]"))
    licenses = let(taken, lambda t: F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(r"\[([^\]]+)\]"), F.lit(1)))), ","))
    return found.select(
        "doc_id",
        F.size("names").cast("long").alias("n_sentences"),
        F.array_join("names", ",").alias("sentence_ids"),
        licenses.alias("licenses"),
    )


def oracle_sql() -> str:
    """The scan in DuckDB SQL, from the same tables of fixed values."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(s)}, {quote(n)})" for s, n in known().items())
    taken = "coalesce(string_agg('<' || name || '>', '' ORDER BY i, j) FILTER (name IS NOT NULL), '')"
    for spdx, parts in RULES:
        taken = f"replace({taken}, {quote(''.join(f'<{p}>' for p in parts))}, {quote(f'[{spdx}]')})"
    ended = "coalesce(text, '')"
    for pattern, kept in (*STEPS, (SENTENCE_END, (1, 2, "\u0001"))):
        made = " || ".join(f"'\\{k}'" if isinstance(k, int) else "chr(1)" for k in kept)
        ended = f"regexp_replace({ended}, '{pattern}', {made}, 'g')"
    cut = rf"string_split_regex({ended}, '\x01|\n[\x20\x09-\x0D]*\n')"
    return rf"""
WITH known(sentence, name) AS (VALUES {values}),
units AS (SELECT doc_id, unnest({cut}) AS unit, generate_subscripts({cut}, 1) AS i FROM documents),
parts AS (
  SELECT doc_id, i, 0 AS j, unit AS s FROM units
  UNION ALL
  SELECT doc_id, i, j, s FROM (
    SELECT doc_id, i, unnest(string_split(unit, chr(10))) AS s, generate_subscripts(string_split(unit, chr(10)), 1) AS j
    FROM units WHERE contains(unit, chr(10)))),
named AS (
  SELECT p.doc_id, p.i, p.j, k.name FROM parts p
  JOIN known k ON trim(regexp_replace(lower(p.s), '[^a-z0-9]+', ' ', 'g')) = k.sentence),
rows AS (
  SELECT d.doc_id, count(name) AS n_sentences,
    coalesce(string_agg(name, ',' ORDER BY i, j) FILTER (name IS NOT NULL), '') AS sentence_ids, {taken} AS taken
  FROM documents d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, n_sentences, sentence_ids,
  array_to_string(list_sort(list_distinct(regexp_extract_all(taken, '\[([^\]]+)\]', 1))), ',') AS licenses
FROM rows
"""
