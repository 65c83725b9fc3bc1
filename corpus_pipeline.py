"""Corpus pipeline: from raw documents to token ids in five stages.

Each stage works on all that its predecessor kept, written as Parquet and read
again. Stages that filter return the columns of their input and nothing else;
the last one returns one row of ids per document.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dimstar.llm import (  # noqa: E402
    byte_bpe,
    decontamination,
    quality_classifier,
    quality_rules,
    simhash_dedup,
)
from dimstar.llm.common import last_table, materialise, table, temporary_tables  # noqa: E402

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, trained on the labels, predicts as good."""
    return quality_classifier.drop_rejected(docs, table(spark, sf_dir, "labels"))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    return quality_rules.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash_dedup.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    return byte_bpe.encoded(docs, TOKENIZER, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", classify_quality),
    ("quality rules", apply_quality_rules),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", encode),
]

# Trained models are not SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage leaves in the shared folder besides
    its result is deleted once the result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary_tables(spark) as keep:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
            keep.append(last_table())
    return docs
