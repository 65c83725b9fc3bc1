"""Registered queries of the training-data operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    decontamination,
    fill_in_middle,
    filter_audit,
    license_scan,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    token_counts,
    token_output,
    url_filter,
    warc,
)
from .common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", *quality_rules.BASE, "base_failed", "kept",
                        F.round("anomaly", 6).alias("anomaly"), "threshold")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("row.doc_id", "held_out", "score", "predicted")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.evaluate(url_filter.captures_of(pages), url_filter.lists_of(pages), "page_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                            public_tokenizers.PATTERN, with_ids=False)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    output = token_output.write(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_output.read_back(spark, docs, output)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transformed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_decontamination,
        op2_quality_rules,
        op3_license_scan,
        op4_quality_classifier,
        op5_url_filter,
        op6_byte_bpe,
        op7_token_output,
        op8_token_counts,
        op9_simhash_near_dedup,
        op10_warc,
        op11_filter_audit,
        op12_fill_in_middle,
        op13_suffix_dedup,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op10_warc": warc.ORACLE_SQL, "op11_filter_audit": filter_audit.ORACLE_SQL,
            "op12_fill_in_middle": fill_in_middle.ORACLE_SQL,
            "op1_decontamination": decontamination.ORACLE_SQL, "op5_url_filter": url_filter.ORACLE_SQL}
