"""Registered load queries (validation, dimensions, SCD2, as-of, fact)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fact as FT
from ..operators import validation as V
from ..operators.dims import build_customer_dim_scd2, build_operator_dim, build_supplier_dim, scd2_coherence, scd2_stats
from ..session import stored
from ..sources import driver
from .load import load_driver, validated_driver
from .oracle_etl import LINE_KEY_CTES, with_etl


def _rules(table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return validated_driver(spark, sf_dir).quarantine_of(table)
    return run


def reject_profile(spark, sf_dir):
    return V.reject_profile(validated_driver(spark, sf_dir).quarantine)


def reject_gate(spark, sf_dir):
    """V28 + V29 on requests under the source's line key: lines that share one are rejected as duplicates."""
    v = V.validate_all(driver.customers_entity(spark, sf_dir), driver.suppliers_entity(spark, sf_dir),
                       driver.operators_entity(spark, sf_dir), driver.requests_entity(spark, sf_dir, numbered=False),
                       driver.driver_rules())
    return V.validation_summary(v.totals, v.quarantine)


def reject_gate_edge(spark, sf_dir):
    """V29 on tables that pass: suppliers under the limit, operators exactly at it."""
    suppliers = driver.suppliers_entity(spark, sf_dir).withColumn(
        "is_active", F.when(F.col("id") % 25 != 0, F.col("is_active")))
    operators = driver.operators_entity(spark, sf_dir).withColumn(
        "status", F.when(F.col("id") % 20 == 0, F.lit("retired")).otherwise(F.col("status")))
    v = V.validate_all(driver.customers_entity(spark, sf_dir), suppliers, operators,
                       driver.requests_entity(spark, sf_dir), driver.accepting_rules())
    return V.validation_summary(v.totals, v.quarantine)


def valid_requests(spark, sf_dir):
    return validated_driver(spark, sf_dir).requests_ok


def customer_dim(spark, sf_dir):
    return build_customer_dim_scd2(validated_driver(spark, sf_dir).customers_ok)


def supplier_dim(spark, sf_dir):
    return build_supplier_dim(validated_driver(spark, sf_dir).suppliers_ok)


def operator_dim(spark, sf_dir):
    return build_operator_dim(validated_driver(spark, sf_dir).operators_ok)


def scd2_stats_q(spark, sf_dir):
    return scd2_stats(customer_dim(spark, sf_dir))


def scd2_coherence_q(spark, sf_dir):
    v = validated_driver(spark, sf_dir)
    dim = build_customer_dim_scd2(v.customers_ok)
    status = v.customers_ok.select(F.col("id").alias("customer_id"), "status")
    return scd2_coherence(dim.join(status, "customer_id")).select("customer_id", "is_current", "status")


def asof_lookup(spark, sf_dir):
    v = validated_driver(spark, sf_dir)
    dim = build_customer_dim_scd2(v.customers_ok)
    return FT.customer_keys(v.requests_ok, v.customers_ok, dim).withColumnRenamed("id", "request_id")


def asof_cardinality(spark, sf_dir):
    v = validated_driver(spark, sf_dir)
    dim = build_customer_dim_scd2(v.customers_ok)
    return FT.asof_cardinality(FT.customer_keys(v.requests_ok, v.customers_ok, dim))


def request_fact(spark, sf_dir):
    return load_driver(spark, sf_dir).fact


def hash_uniqueness(spark, sf_dir):
    return FT.hash_uniqueness(stored(load_driver(spark, sf_dir).fact.select("hash_record"), "hashes"))


def dedup_by_hash(spark, sf_dir):
    return FT.dedup_by_hash(load_driver(spark, sf_dir).fact)


Q = '"table"'
GATE = f"""
SELECT t.{Q}, t.n_total, t.n_total - COALESCE(k.n_ko, 0) AS n_ok, COALESCE(k.n_ko, 0) AS n_ko,
       CASE WHEN t.n_total > 0 THEN CAST(COALESCE(k.n_ko, 0) AS DOUBLE) / t.n_total END AS ko_ratio,
       COALESCE(CASE WHEN t.n_total > 0 THEN CAST(COALESCE(k.n_ko, 0) AS DOUBLE) / t.n_total END > 0.05, FALSE) AS abort
FROM totals t LEFT JOIN (SELECT {Q}, COUNT(*) AS n_ko FROM quarantine GROUP BY {Q}) k ON t.{Q} = k.{Q}"""
SQL = {
    "rules_customers": with_etl(f"SELECT {Q}, key, reason FROM quarantine WHERE {Q} = 'customers'"),
    "rules_suppliers": with_etl(f"SELECT {Q}, key, reason FROM quarantine WHERE {Q} = 'suppliers'"),
    "rules_operators": with_etl(f"SELECT {Q}, key, reason FROM quarantine WHERE {Q} = 'operators'"),
    "rules_requests": with_etl(f"SELECT {Q}, key, reason FROM quarantine WHERE {Q} = 'requests'"),
    "reject_profile": with_etl(f"SELECT {Q}, reason, COUNT(*) AS n_rejected FROM quarantine GROUP BY {Q}, reason"),
    "reject_gate": with_etl(GATE, entities=LINE_KEY_CTES),
    "valid_requests": with_etl("SELECT * FROM r_ok"),
    "customer_dim": with_etl("SELECT * FROM cdim", dims=True),
    "supplier_dim": with_etl("SELECT * FROM sdim", dims=True),
    "operator_dim": with_etl("SELECT * FROM odim", dims=True),
    "scd2_stats": with_etl("""
SELECT COUNT(*) AS n_personas, COUNT(CASE WHEN n > 1 THEN 1 END) AS n_personas_multi,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(cur), 0) AS BIGINT) AS n_current
FROM (SELECT fiscal_code_hash, COUNT(*) AS n, SUM(is_current) AS cur FROM cdim GROUP BY fiscal_code_hash) t""",
                           dims=True),
    "scd2_coherence": with_etl("""
SELECT d.customer_id, d.is_current, c.status FROM cdim d JOIN c_ok c ON d.customer_id = c.id
WHERE (d.is_current = 1) <> COALESCE(c.status = 'active', FALSE)""", dims=True),
    "asof_lookup": with_etl("SELECT CAST(id AS BIGINT) AS request_id, customer_key FROM r_key", dims=True),
    "asof_cardinality": with_etl("""
SELECT COUNT(*) AS n_probes, COUNT(customer_key) AS n_matched,
       COUNT(CASE WHEN customer_key IS NULL THEN 1 END) AS n_unmatched FROM r_key""", dims=True),
    "request_fact": with_etl("SELECT * FROM rfact", dims=True),
    "hash_uniqueness": with_etl("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT hash_record) AS n_distinct_hash,
       CAST(COUNT(DISTINCT hash_record) AS DOUBLE) / NULLIF(COUNT(*), 0) AS distinct_ratio FROM rfact""",
                                dims=True),
    "dedup_by_hash": with_etl("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY hash_record ORDER BY request_id) AS rn FROM rfact) t
WHERE rn = 1""", dims=True),
}

SQL["reject_gate_edge"] = (
    with_etl(GATE).replace("'AMERICA', 'ASIA', 'EUROPE')", "'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')")
    .replace("'SMALL', 'STANDARD')", "'SMALL', 'STANDARD', 'PROMO')")
    .replace("CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS is_active",
             "CASE WHEN s_suppkey % 25 = 0 THEN NULL WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS is_active")
    .replace("'active' AS status\n  FROM part", "CASE WHEN p_partkey % 20 = 0 THEN 'retired' ELSE 'active' END AS status\n  FROM part"))

BUILDERS = {
    "rules_customers": _rules("customers"),
    "rules_suppliers": _rules("suppliers"),
    "rules_operators": _rules("operators"),
    "rules_requests": _rules("requests"),
    "reject_profile": reject_profile,
    "reject_gate": reject_gate,
    "reject_gate_edge": reject_gate_edge,
    "valid_requests": valid_requests,
    "customer_dim": customer_dim,
    "supplier_dim": supplier_dim,
    "operator_dim": operator_dim,
    "scd2_stats": scd2_stats_q,
    "scd2_coherence": scd2_coherence_q,
    "asof_lookup": asof_lookup,
    "asof_cardinality": asof_cardinality,
    "request_fact": request_fact,
    "hash_uniqueness": hash_uniqueness,
    "dedup_by_hash": dedup_by_hash,
}


def entries() -> dict:
    return {name: (b, SQL.get(name)) for name, b in BUILDERS.items()}
