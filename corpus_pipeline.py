"""Cleaning of a text corpus: stages that each read what the one before kept.

``run`` writes the result of every stage as Parquet into the shared folder and reads it
again, so a lost executor never repeats earlier stages.

Defined results: documents with NULL text or without a letter have no language and go in the
first stage. Of equal texts, and of texts linked by their fingerprints, the smallest doc_id
stays; ids that are NULL count as the smallest. Repeated rows are equal texts. Texts of any length are
read and redacted whole, further columns are carried to the last stage, and an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import exact_dedup, langid, packing, secrets, simhash
from panelkit.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go. It learns from the documents it is given."""
    return langid.drop_rejected(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; what the scan finds is replaced in their texts."""
    return secrets.redact(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]

ORACLE_SQL = None  # the models and fingerprints of the stages have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
