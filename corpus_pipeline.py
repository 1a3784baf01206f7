"""The training corpus in five stages, from ``documents`` to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it
kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import bpe, exact_dedup, minhash, mixing, quality
from eventloom.llm.common import table
from eventloom.llm.queries import VOCABULARY
from eventloom.session import pin, stage_table


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates (five words, 0.8) the smallest id stays."""
    return minhash.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, some twice, some not at all."""
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked by decoding them again."""
    return bpe.encode_digest(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", select_quality),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("mixing", mix),
    ("byte-level BPE", encode),
]

# The classifier is fitted, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(pin(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
