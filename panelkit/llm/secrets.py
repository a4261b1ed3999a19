"""Secret scans with an incremental ledger of blobs.

A blob is the content of a version, addressed by its SHA-256. The ledger holds, for every
blob ever scanned, the rule versions that were applied and what they found, nothing found
included. A scan takes versions (doc_id is the path), addresses their content, and looks
up which pairs of blob and rule version the ledger lacks; only those are scanned, each blob
once and with the missing rules only, however many paths hold it. Findings are then joined
back to all paths. Text travels once, and only for one path of each unseen blob.

Defined results: NULL text is the empty blob. Paths may repeat, be NULL or hold several
versions; each row gets the findings of its own content. Spans are code points of the
whole text, end exclusive. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import KEY, keyed_texts, row_key, whole_rows
from panelkit.staging import exists, stage


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of ``group``; ``hints`` are lower-case strings one of
    which is in every text that can match (none: no such string is known)."""

    kind: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 0
    flags: int = re.ASCII
    hints: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        flags=re.ASCII | re.IGNORECASE,
        hints=("password", "passwd", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, hints=("akia",)),
    Rule("hex", r"[0-9a-f]{24,}"),  # the maximal runs of 24 or more
)
# A private key from its header to its END line; where another header or the end of the text comes first, to the
# end of the base64 lines, which may be quoted, commented or joined by escaped line ends.
KEY_NAME = r"[A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
KEY_GAP = r"""(?:\\[nrt]|//[ \t]|[\s"'`,;>#*|+\\])"""
KEY_BODY = (
    rf"(?:[^-]|-(?!----(?:BEGIN |END {KEY_NAME})))*+-----END {KEY_NAME}"
    rf"|(?:{KEY_GAP}++(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset):[^\n\\]*+)*+"
    rf"(?:{KEY_GAP}++[A-Za-z0-9+/=]{{16,}}+)*+(?:{KEY_GAP}++[A-Za-z0-9+/=]++(?=[\s\"'\\,;]*(?:\n|\Z)))?+"
)
RULES = (
    *BASE,
    # begins where a token may, and never steps back: linear in the text
    Rule("jwt", r"(?<![\w-])eyJ[\w-]{10,}+\.eyJ[\w-]{10,}+\.[\w-]{10,}+", version=2, hints=("eyj",)),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]{36,}", hints=("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("pem", rf"-----BEGIN {KEY_NAME}(?:{KEY_BODY})", version=2, hints=("-----begin",)),
)
REMEMBERED = 1 << 18  # addresses a task remembers; only a matter of speed
SPAN = "struct<kind:string,version:int,start:bigint,end:bigint>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


def scan_text(text: str, rules: list[tuple[Rule, re.Pattern]]) -> list[tuple[str, int, int, int]]:
    """(kind, version, start, end) of what the rules find in a whole text."""
    lower = text.lower()
    found = []
    for rule, pattern in rules:
        if rule.hints and not any(h in lower for h in rule.hints):
            continue
        for m in pattern.finditer(text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((rule.kind, rule.version, m.start(), m.end()))
    return found


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def address(versions: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Narrow table of all paths and the address of what they hold."""
    blob = blob_of(F.col("text")).alias("blob")
    return stage(versions.select("doc_id", blob, *row_key(), *carry), "paths")


def unseen(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Key of one row of every blob that lacks a rule version, with the missing names."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    one = paths.groupBy("blob").agg(F.min(F.struct(*KEY)).alias("row"))
    nothing = F.array().cast("array<string>")
    missing = F.array_except(wanted, F.coalesce("seen", nothing))
    return (
        one.join(seen, "blob", "left")
        .select("blob", *[F.col(f"row.{k}").alias(k) for k in KEY], missing.alias("missing"))
        .filter(F.size("missing") > 0)
    )


def scan(versions: DataFrame, todo: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows for the pairs of ``todo``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = {r.name: (r, re.compile(r.pattern, r.flags)) for r in rules}
        done: set[bytes] = set()  # repeated rows meet in one task: only the first is scanned
        for b in batches:
            fresh = [blob not in done and not done.add(blob) for blob in map(bytes, b["blob"])]
            b = b[fresh]
            if len(done) >= REMEMBERED:
                done.clear()
            spans = [scan_text(t or "", [ready[n] for n in names]) for t, names in zip(b["text"], b["missing"])]
            made = [[dict(zip(("kind", "version", "start", "end"), s)) for s in found] for found in spans]
            yield pd.DataFrame({"blob": b["blob"], "rules": b["missing"], "spans": made})

    texts = keyed_texts(versions).join(todo, list(KEY))
    return texts.select("blob", "missing", "text").mapInPandas(run, LEDGER).dropDuplicates(["blob"])


def findings(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows of ``paths`` with the spans of their content, ordered by start, then rule."""
    wanted = F.array(*[F.lit(r.name) for r in rules])
    name = lambda s: F.concat(s["kind"], F.lit("@"), s["version"].cast("string"))
    current = F.filter("spans", lambda s: F.array_contains(wanted, name(s)))
    found = ledger.select("blob", current.alias("spans")).filter(F.size("spans") > 0)
    whole = found.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    place = lambda s: F.struct(s["start"], F.array_position(wanted, name(s)).alias("rank"), s.alias("span"))
    ordered = F.transform(F.sort_array(F.transform("spans", place)), lambda p: p["span"])
    spans = F.coalesce(F.col("found"), F.array().cast(f"array<{SPAN}>"))
    whole = stage(whole.select("blob", ordered.alias("found")), "found")  # so that Spark can split a hot blob's paths
    return paths.join(whole, "blob", "left").withColumn("spans", spans).drop("found")


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def update(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()):
    """(paths, new ledger rows): what the ledger lacked, scanned and written once."""
    paths = address(versions, carry)
    return paths, stage(scan(versions, unseen(paths, ledger, rules), rules), "ledger")


def scan_with_ledger(versions: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings of all versions; the ledger at ``ledger_path`` grows by what was unseen.

    New rows are written in full before they are appended, so a lost executor or a repeated
    run never leaves half a scan; a pair appended twice is read once.
    """
    spark = versions.sparkSession
    known = exists(spark, ledger_path)
    old = spark.read.schema(LEDGER).parquet(ledger_path) if known else empty_ledger(spark)
    paths, new = update(versions, old, rules)
    new.write.mode("append").parquet(ledger_path)
    everything = spark.read.schema(LEDGER).parquet(ledger_path).dropDuplicates(["blob", "rules"])
    return findings(paths, everything, rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Findings of every document, from an empty ledger."""
    paths, new = update(docs, empty_ledger(docs.sparkSession), rules, carry)
    return findings(paths, new, rules)


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span, overlapping ones merged, replaced by ``mark``."""

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["out"], gap, F.lit(mark))
        out = F.when(s["start"] >= state["at"], fresh).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(
        s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))
    )
    return F.aggregate(spans, start, step, rest)


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """All documents, what was found replaced by ``mark`` and n_chars counted anew."""
    found = find_secrets(docs).select("blob", "spans").filter(F.size("spans") > 0).dropDuplicates(["blob"])
    addressed = whole_rows(docs).withColumn("blob", blob_of(F.col("whole.text")))
    joined = addressed.join(found, "blob", "left")
    text = redacted(F.col("whole.text"), F.col("spans"), mark)
    whole = F.col("whole").withField("text", text)
    if "n_chars" in docs.columns:
        whole = whole.withField("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    changed = F.when(F.col("spans").isNotNull(), whole).otherwise(F.col("whole"))
    return joined.select(changed.alias("whole")).select("whole.*")
