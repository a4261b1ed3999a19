"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import bpe, chat, collocations, exact_dedup, langid, lexical, licenses, packing, pieces, quality, secrets, sharding, simhash
from panelkit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


SQL["op1_license_sentence_rules"] = licenses.oracle_sql()


@query
def op2_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op3_optimal_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_n_best_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def _span_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


@query
def op5_secret_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the findings; spans come ordered by start, then rule."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secrets.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(_span_text(base), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


@query
def op6_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op7_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes the template's own marks."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", quoted), (-7, 1, "assistant", quoted)], rows.schema)
    return chat.digests(chat.read_back(chat.format_conversations(rows.unionByName(planted))))


SQL["op7_chat_round_trip"] = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (
  SELECT *, CASE WHEN regexp_matches(text, ' (\[/INST\]|<</SYS>>|</s>|</role>)|&(amp|lt|gt|lb);')
    THEN replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;')
    ELSE text END AS written,
    CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7
      ELSE 16 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '[', '&lb;'))
    END AS marks
  FROM r)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(written) + marks + 2)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id
"""


@query
def op8_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


SQL["op8_tree_merge_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op9_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "fingerprint", "component_id")


@query
def op10_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_bitmap_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, as digests."""
    made = bpe.encode(table(spark, sf_dir, "documents"), read_back=True)
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2(bpe.decimal(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query
def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op12_dual_tree_search"] = lexical.ORACLE


@query
def op13_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op13_stripe_collocations"] = collocations.ORACLE
