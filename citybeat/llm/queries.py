"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citybeat.llm import (
    byte_bpe,
    chains,
    content_sort,
    gru_lm,
    line_crf,
    mixing,
    packing,
    radix_dedup,
    recompression,
    secrets,
    signature_join,
    spelling,
    training_order,
)
from citybeat.llm.common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens; one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), digest=True)


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the materialised training order, read back from its shard."""
    shards = training_order.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return training_order.read_from(shards).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 words and more that documents share."""
    return chains.find_passages(table(spark, sf_dir, "documents"))


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document; the field is trained on ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return line_crf.judge_documents(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of every document."""
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credential spans of every document with corpus-wide ownership."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_digest(base), 256).alias("base_sha256"),
        secrets.span_digest(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )


def op7_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the trained model and the smoothed unigram."""
    return gru_lm.score(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE round trip of every document."""
    return byte_bpe.encode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_BPE),
        public_tokenizers.PATTERN,
        finish=byte_bpe.digests,
        finish_schema="ids_sha256 string, decoded_sha256 string",
    )


def op9_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 400-byte strings, and whether it shares a shorter passage."""
    found = radix_dedup.remove_repeated(table(spark, sf_dir, "documents"), digest=True, passages=True)
    return found.withColumn("changed", F.col("n_removed") > 0).withColumn("shares_passage", F.col("n_shared") > 0)


def op10_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every document (five words, similarity 0.75)."""
    return signature_join.link_documents(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its common form; one run in 199 loses a letter first."""
    return spelling.variants(table(spark, sf_dir, "documents"), every=199)


def op12_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document a mix of the sources takes; documents labelled good are favoured."""
    quality = mixing.label_weights(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), quality)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, some of which are made to repeat first."""
    return recompression.periodic_runs(table(spark, sf_dir, "documents"), plant=True, whole=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_packing": op1_vector_packing,
    "op2_training_order": op2_training_order,
    "op3_collinear_chains": op3_collinear_chains,
    "op4_line_crf": op4_line_crf,
    "op5_content_sort": op5_content_sort,
    "op6_secret_scan": op6_secret_scan,
    "op7_gru_lm": op7_gru_lm,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_radix_dedup": op9_radix_dedup,
    "op10_signature_join": op10_signature_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_weighted_mix": op12_weighted_mix,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op5_content_sort": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS raw,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents
        ), g AS (
            SELECT doc_id, sha256(norm) AS text_sha256,
                   first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY norm) AS group_size,
                   row_number() OVER w = 1 AS kept
            FROM d
            WINDOW w AS (PARTITION BY norm ORDER BY length(raw) DESC, doc_id ASC NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM g
    """,
}
