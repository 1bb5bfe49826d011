"""Corpus preparation: quality rules, exact dedup, near dedup, secret redaction, packing.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's documents.  All stages but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citybeat.llm import content_sort, line_crf, packing, secrets, signature_join
from citybeat.llm.common import materialise, table
from citybeat.llm.queries import WORD_BPE


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose words lie mostly on content lines."""
    return line_crf.keep_content(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal normalised texts."""
    return content_sort.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near duplicates (five words, 0.75)."""
    return signature_join.keep_one(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, credentials that look live replaced in its text."""
    clean = secrets.redact(docs, secrets.find_secrets(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents packed into training sequences; one row per piece."""
    return packing.pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_redaction", secret_redaction),
    ("packing", pack),
]

#: SQL cannot express the field's labels, the tokenizer or the packing; tests hold ``run`` to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
