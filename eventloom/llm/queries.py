"""One query per operator over the whole of its table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, chat, exact_dedup, extract, fingerprints, lattice, merkle, minhash, mixing, pii, quality, search, suffix_dedup
from eventloom.llm.common import table
from eventloom.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(pin(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return fn

    return register


@query("op1_mixing", mixing.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_digest(suffix_dedup.without_repeats(table(spark, sf_dir, "documents")))


@query("op3_lattice")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.lattice_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op4_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_decisions(table(spark, sf_dir, "documents"), k=3, percent=85)


@query("op5_chat", chat.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.chat_digest(chat.format_chats(rows))


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode_digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op9_extract")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op10_exact_dedup", """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_decisions(table(spark, sf_dir, "documents"))


@query("op11_merkle", merkle.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digest(table(spark, sf_dir, "documents"))


@query("op12_search", search.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_pii", pii.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.find_pii(table(spark, sf_dir, "documents")))
