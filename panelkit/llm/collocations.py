"""Phrase collocations by the stripes pattern, exact and per language.

A stripe is a prefix with a counter of the words that follow it. Each task counts the
stripes of a bounded chunk of text; stripes of equal prefixes meet in a shuffle, sorted, and
are merged elementwise, one after the other. A merged stripe gives the counts of all
extensions of its prefix, the count of the prefix itself (occurrences at the end of a piece
and before other words are part of its total), and the largest extension that may subsume it.

Stripes are counted from short to long. A phrase is only frequent if both phrases
it has without its last and its first word are. Tasks know these by a bit filter, whose size
follows their number up to ``MOST_BITS``; false positives cost work and change nothing,
because the merged counts are exact. Prefixes that begin more than one in ``PARTS`` of all
words are cut into parts by a hash of the next word; there are at most ``PARTS`` such prefixes.

Defined results: NULL text counts as empty and NULL lang as ``und``. Every row counts, repeated
ones too. Equal scores are ordered by count, then by phrase in UTF-8 order. Empty tables give
no rows; further columns are ignored. Whole texts are counted, however long; memory of a task
grows with its longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.staging import stage

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences of a candidate
TOP = 2000  # phrases of a language
SUBSUMED = 80  # per cent
CHUNK = 1 << 23  # bytes of text that a task counts at a time
PARTS = 1024
BLOCK_BITS = 1 << 15
MOST_BITS = 1 << 28  # 32 MB
BITS = 16  # per frequent phrase

MARK = b"\xff"  # never part of UTF-8; stands between pieces
COUNTS = "lang string, phrase string, a bigint"
STRIPES = "lang string, prefix string, part int, total bigint, nexts string, counts array<bigint>"
ENTRIES = "lang string, prefix string, next string, a bigint, total bigint"


def letter_table() -> bytes:
    """A-Z lower, tabs as spaces, ends of pieces as ``MARK``."""
    out = bytearray(range(256))
    out[65:91] = range(97, 123)
    out[9] = 32
    for end in b".,;:!?\n\x0b\x0c\r":
        out[end] = MARK[0]
    return bytes(out)


TABLE = letter_table()


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text with marks between its pieces and at its end."""
    return (text or "").encode().translate(TABLE).replace(MARK, b" \xff ").split() + [MARK]


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list[bytes]]]:
    """(language, tokens) of rows (lang, text), at most about ``most`` bytes at a time."""
    for batch in batches:
        held, size = {}, 0
        for lang, text in zip(*batch.columns):
            text = text.as_py()
            if text:
                held.setdefault(lang.as_py(), []).extend(tokens_of(text))
                size += len(text)
                if size >= most:
                    yield from held.items()
                    held, size = {}, 0
        yield from held.items()


# --- hashes and filters ---------------------------------------------------------


def fold(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its prefix and of its last word."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + words
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), dtype=np.uint64, count=len(words))


def slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a phrase in a filter; ``bits`` is a power of two."""
    low = np.uint64(bits - 1)
    return (hashes & low).astype(np.int64), ((hashes >> np.uint64(32)) & low).astype(np.int64)


def seen(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether phrases may be in a filter."""
    one, two = slots(hashes, bits.size * 8)
    return ((bits[one >> 3] >> (one & 7)) & (bits[two >> 3] >> (two & 7)) & 1).astype(bool)


def filter_of(frequent: DataFrame, size: int) -> np.ndarray:
    """Bit filter of (lang, phrase) rows of ``size`` words, built in blocks by Spark."""
    wanted = max(BLOCK_BITS, BITS * frequent.count())
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            names = [p.encode() for p in batch.column(1).to_pylist()]
            made = word_hashes([x.encode() for x in langs])
            for words in zip(*(n.split(b" ") for n in names)):
                made = fold(made, word_hashes(list(words)))
            own = np.unique(np.concatenate(slots(made, bits)))
            yield pa.RecordBatch.from_arrays(
                [pa.array((own // BLOCK_BITS).astype(np.int32)), pa.array((own % BLOCK_BITS).astype(np.int32))],
                names=["block", "bit"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for own in batch.column(1):
                flags = np.zeros(BLOCK_BITS, dtype=np.uint8)
                flags[own.values.to_numpy()] = 1
                packed.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, type=pa.binary())], names=["block", "bytes"])

    placed = frequent.select("lang", "phrase").mapInArrow(place, "block int, bit int")
    blocks = placed.groupBy("block").agg(F.collect_set("bit").alias("bit"))  # at most BLOCK_BITS a block
    out = np.zeros(bits // 8, dtype=np.uint8)
    width = BLOCK_BITS // 8
    for row in blocks.mapInArrow(pack, "block int, bytes binary").toLocalIterator():
        out[row.block * width : (row.block + 1) * width] = np.frombuffer(row.bytes, dtype=np.uint8)
    return out


# --- counting -------------------------------------------------------------------


def pieces_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def count_words(docs: DataFrame) -> DataFrame:
    """Occurrences of every word of a language, and of all its words in a row without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for lang, tokens in chunks(batches, CHUNK):
            counts = Counter(tokens)
            counts.pop(MARK, None)
            names = [None, *(w.decode() for w in counts)]
            values = [sum(counts.values()), *counts.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names)), pa.array(names, type=pa.string()), pa.array(values, type=pa.int64())],
                names=["lang", "phrase", "a"],
            )

    return pieces_of(docs).mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def chunk_stripes(lang: str, tokens: list[bytes], size: int, filters: list[np.ndarray], hot: dict[tuple[str, str], int]) -> pa.RecordBatch:
    """Stripes of the prefixes of ``size - 1`` words that may be frequent."""
    index = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    names, width = list(index), len(index)
    ids = np.fromiter(map(index.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    hashes = word_hashes(names)
    single = fold(word_hashes([lang.encode()]), hashes)
    known = seen(filters[0], single)
    known[index[MARK]] = False
    fine = known[ids]  # whether a phrase of the length so far may be frequent here
    for length in range(2, size):
        at = np.flatnonzero(fine[:-1] & fine[1:])
        made = single[ids[at]]
        for k in range(1, length):
            made = fold(made, hashes[ids[at + k]])
        fine = np.zeros(len(fine) - 1, dtype=bool)
        fine[at[seen(filters[length - 1], made)]] = True
    at = np.flatnonzero(fine)
    prefix = ids[at]
    for k in range(1, size - 1):
        prefix = np.unique(prefix * width + ids[at + k], return_inverse=True)[1]
    _, first, prefix = np.unique(prefix, return_index=True, return_inverse=True)
    totals = np.bincount(prefix, minlength=len(first))
    heads = [b" ".join(map(names.__getitem__, own)).decode() for own in zip(*(ids[at[first] + k].tolist() for k in range(size - 1)))]
    more = np.append(fine[1:], False)[at]
    pairs, counts = np.unique(prefix[more] * width + ids[at[more] + size - 1], return_counts=True)
    owner, word = np.divmod(pairs, width)
    parts = np.array([hot.get((lang, h), 1) for h in heads], dtype=np.int64)
    starts = np.cumsum(parts) - parts  # first row of every prefix
    row = starts[owner] + (hashes[word] % parts[owner].astype(np.uint64)).astype(np.int64)
    order = np.argsort(row, kind="stable")
    words = list(map(names.__getitem__, word[order].tolist()))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=int(parts.sum())))]).astype(np.int32)
    cuts = ends.tolist()
    head = np.repeat(np.arange(len(heads)), parts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(head), type=pa.string()),
            pa.array(heads, type=pa.string()).take(pa.array(head)),
            pa.array((np.arange(len(head)) - starts[head]).astype(np.int32)),
            pa.array(totals[head], type=pa.int64()),
            pa.array([b" ".join(words[a:b]).decode() for a, b in zip(cuts, cuts[1:])], type=pa.string()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(counts[order], type=pa.int64())),
        ],
        names=["lang", "prefix", "part", "total", "nexts", "counts"],
    )


def merged(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Elementwise sums of stripes sorted by prefix: (stripe, next, a) and the stripes' totals."""
    keys = [table.column(c).combine_chunks() for c in ("lang", "prefix", "part")]
    changed = np.zeros(table.num_rows, dtype=bool)
    for key in keys:
        changed[1:] |= pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
    stripe = np.cumsum(changed)
    first = np.flatnonzero(np.concatenate([[True], changed[1:]]))
    total = np.add.reduceat(table.column("total").to_numpy(), first)
    lists = table.column("counts").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    some = pa.array(sizes > 0)
    nexts = pc.split_pattern(table.column("nexts").combine_chunks().filter(some), " ").flatten()
    pairs = pa.table({"stripe": np.repeat(stripe, sizes), "next": nexts, "a": lists.flatten()})
    sums = pairs.group_by(["stripe", "next"], use_threads=False).aggregate([("a", "sum")])
    stripes = pa.table({"lang": keys[0].take(pa.array(first)), "prefix": keys[1].take(pa.array(first)),
                        "part": keys[2].take(pa.array(first)), "total": pa.array(total)})
    return sums.rename_columns(["stripe", "next", "a"]), stripes


def merge_stripes(stripes: DataFrame, least: int) -> DataFrame:
    """Extensions with at least ``least`` occurrences and the total of their prefix."""
    key = ("lang", "prefix", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_stripe = None  # of the last prefix, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if open_stripe is not None:
                table = pa.concat_tables([open_stripe, table])
            sums, made = merged(table)
            last = made.num_rows - 1
            tail = pc.equal(sums["stripe"], last)
            rest = sums.filter(tail)
            ends = pa.array([0, rest.num_rows], type=pa.int32())
            open_stripe = pa.table(
                {
                    **{k: made[k].slice(last) for k in (*key, "total")},
                    "nexts": [" ".join(rest["next"].to_pylist())],
                    "counts": pa.ListArray.from_arrays(ends, rest["a"].combine_chunks()),
                }
            ).cast(table.schema)
            yield from finished(sums.filter(pc.invert(tail)), made)
        if open_stripe is not None:
            yield from finished(*merged(open_stripe))

    def finished(sums: pa.Table, made: pa.Table) -> Iterator[pa.RecordBatch]:
        kept = sums.filter(pc.greater_equal(sums["a"], least))
        own = made.take(kept["stripe"])
        yield from pa.table(
            {"lang": own["lang"], "prefix": own["prefix"], "next": kept["next"], "a": kept["a"], "total": own["total"]}
        ).to_batches()

    return stripes.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, ENTRIES)


def count_extensions(docs: DataFrame, size: int, shorter: list[DataFrame], filters: list[np.ndarray], n: int, least: int) -> DataFrame:
    """Frequent phrases of ``size`` words as extensions of their prefixes."""
    share = F.ceil(F.col("a") * PARTS / F.lit(n)).cast("int")
    hot = {(r.lang, r.phrase): r.parts for r in shorter[-1].where(F.col("a") * PARTS > n).select("lang", "phrase", share.alias("parts")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(([f.tobytes() for f in filters], hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, hot = shared.value
        filters = [np.frombuffer(p, dtype=np.uint8) for p in packed]
        for lang, tokens in chunks(batches, CHUNK):
            yield chunk_stripes(lang, tokens, size, filters, hot)

    entries = stage(merge_stripes(pieces_of(docs).mapInArrow(run, STRIPES), least), "stripes")
    return entries.select("*", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.lit(size).alias("size"))


# --- collocations ---------------------------------------------------------------


def exact(name: str):
    return F.col(name).cast("decimal(20,0)")


def part_of(start, length):
    return F.array_join(F.slice("words", start, length), " ")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED) -> DataFrame:
    """The first phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    words = stage(count_words(docs).where((F.col("a") >= least) | F.col("phrase").isNull()), "words")
    sizes = words.where("phrase IS NULL").select("lang", F.col("a").alias("n"))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    levels, filters = [words.where("phrase IS NOT NULL")], []
    for size in range(2, longest + 1):
        filters.append(filter_of(levels[-1], size - 1))
        levels.append(count_extensions(docs, size, levels, filters, n, least))

    counted = levels[0].select("lang", "phrase", "a")
    for level in levels[1:]:
        counted = counted.unionByName(level.select("lang", "phrase", "a"))
    longer = levels[1]
    for level in levels[2:]:
        longer = longer.unionByName(level)
    longer = longer.withColumn("words", F.split("phrase", " "))

    rest = part_of(2, F.col("size") - 1)
    above = longer.where("size > 2")
    largest = (
        above.select("lang", F.col("prefix").alias("phrase"), "a")
        .unionByName(above.select("lang", rest.alias("phrase"), "a"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("largest"))
    )
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = longer.select("lang", "phrase", "a", "size", "total", "words", cut)
    cuts = cuts.select(
        "lang", "phrase", "a", "total", "k", (F.col("k") == F.col("size") - 1).alias("last"),
        part_of(1, F.col("k")).alias("left"), part_of(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    right = counted.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    left = counted.select("lang", F.col("phrase").alias("left"), F.col("a").alias("found"))
    sided = cuts.join(right, ["lang", "right"]).join(left, ["lang", "left"])
    l_count = F.when(F.col("last"), F.col("total")).otherwise(F.col("found"))
    score = F.expr("CAST(a AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + r)")
    scored = sided.withColumn("l", l_count).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = lowest.join(largest, ["lang", "phrase"], "left").where(
        F.col("largest").isNull() | (100 * exact("largest") < subsumed * exact("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (SELECT lang, k, w[i:i + k - 1] AS words
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
        FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, words, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT lang, words, k, a, unnest(generate_series(1, k - 1)) AS j FROM c),
s AS (SELECT x.lang, x.words, x.a, j, l.a AS l, r.a AS r,
    ((2000000::HUGEINT * x.a) // (l.a::HUGEINT + r.a))::BIGINT AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.words = x.words[1:j]
  JOIN f r ON r.lang = x.lang AND r.words = x.words[j + 1:x.k]),
m AS (SELECT lang, words, a, unnest(min({'score': score, 'j': j, 'l': l, 'r': r})) FROM s GROUP BY lang, words, a),
inside AS (SELECT lang, words[b:e] AS words, max(a) AS a FROM (
    SELECT lang, words, k, a, b, unnest(generate_series(b + 1, k)) AS e
    FROM (SELECT *, unnest(generate_series(1, k - 1)) AS b FROM c WHERE k > 2)) WHERE e - b + 1 < k GROUP BY ALL),
kept AS (SELECT m.* FROM m LEFT JOIN inside i ON i.lang = m.lang AND i.words = m.words
  WHERE i.a IS NULL OR 100::HUGEINT * i.a < 80::HUGEINT * m.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' '))::INT AS rank,
    array_to_string(words, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
