"""Registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import (
    collocations,
    conversation_repair,
    credentials,
    edit_fingerprints,
    exact_dedup,
    lm_scoring,
    packing,
    pfair_mixing,
    quality_knn,
    quality_rules,
    sharding,
    simhash,
    toxicity_pu,
)
from quotelake.llm.common import table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair_mixing.report(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "text_sha256", F.sha2(F.encode(exact_dedup.normalised(), "utf-8"), 256)
    )
    return exact_dedup.exact_dedup(docs, ["doc_id", "text_sha256"]).select(
        "doc_id",
        F.col("__keep_id").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"),
        "text_sha256",
    )


def op8_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest_rows(credentials.find_secrets(table(spark, sf_dir, "documents")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_pu.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "cutoff_level",
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring,
        op2_simhash,
        op3_sharding,
        op4_quality_knn,
        op5_edit_fingerprints,
        op6_pfair_mixing,
        op7_exact_dedup,
        op8_credentials,
        op9_packing,
        op10_toxicity_pu,
        op11_collocations,
        op12_quality_rules,
        op13_conversation_repair,
    )
}

SQL = {
    "op7_exact_dedup": r"""
        with plain as (
            select doc_id, length(coalesce(text, '')) as n_chars,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
            from documents
        ), best as (
            select text_sha256, count(*) as group_size,
                   first(doc_id order by n_chars desc, doc_id) as keep_id
            from plain group by text_sha256
        )
        select p.doc_id, b.keep_id, b.group_size, p.doc_id = b.keep_id as kept, p.text_sha256
        from plain p join best b using (text_sha256)
    """,
}
