"""Fact build (F1-F13): persona lookup, as-of (SCD2) key resolution, key
lookups, flags, row hash, hash statistics and hash deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import date_key
from ..functions.hashing import hash_record, money_text, ts_text
from ..model import FACT_COLUMNS
from .segmented import ffill_in_group, running_sum_in_group
from .sketch import distinct_counts


def asof_join(probes: DataFrame, versions: DataFrame, probe_group: str, probe_ts: str,
              version_group: str, take: Sequence[str], valid_from: str = "valid_from",
              valid_to: str = "valid_to", version_order: Sequence[str] = ()) -> DataFrame:
    """for each probe, the version of its group with
    ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``; columns
    ``take`` of that version are added (NULL when no version matches). The
    intervals of a group must not overlap, as those made by ``lead`` never do;
    ``asof_match_classes`` counts the matches of any intervals. Versions
    without a ``valid_from`` match nothing.

    Probes and versions are merged in one frame ordered by (group, time);
    each probe takes the last version at or before it (forward fill). No
    pairs are formed inside a group, and a group with very many rows is cut
    into several segments (see ``segmented``). Versions with the same
    ``valid_from`` are ordered by ``version_order`` and the last one wins,
    which is the one whose half-open interval is not empty.
    """
    vcols = [valid_from, valid_to, *take]
    vstruct = F.struct(*[F.col(c) for c in vcols])
    group_type, ts_type = probes.schema[probe_group].dataType, probes.schema[probe_ts].dataType
    # columns that the merged frame holds anyway are not moved twice
    held = {c: k for c, k, same in ((probe_group, "_g", group_type == versions.schema[version_group].dataType),
                                    (probe_ts, "_t", ts_type == versions.schema[valid_from].dataType)) if same}
    pstruct = F.struct(*[F.col(c) for c in probes.columns if c not in held] or [F.lit(True).alias("_is")])
    vtype = versions.select(vstruct.alias("v")).schema["v"].dataType
    ptype = probes.select(pstruct.alias("p")).schema["p"].dataType
    vord = F.struct(*[F.col(c) for c in version_order]) if version_order else F.lit(0)
    vord_type = versions.select(vord.alias("o")).schema["o"].dataType
    p = probes.select(
        F.col(probe_group).alias("_g"), F.col(probe_ts).alias("_t"), F.lit(1).alias("_tag"),
        F.lit(None).cast(vord_type).alias("_o"), F.monotonically_increasing_id().alias("_pid"),
        pstruct.alias("_p"), F.lit(None).cast(vtype).alias("_v"))
    v = versions.where(F.col(valid_from).isNotNull()).select(
        F.col(version_group).alias("_g"), F.col(valid_from).alias("_t"), F.lit(0).alias("_tag"),
        vord.cast(vord_type).alias("_o"), F.lit(None).cast("bigint").alias("_pid"),
        F.lit(None).cast(ptype).alias("_p"), vstruct.alias("_v"))
    merged = p.unionByName(v)
    filled = ffill_in_group(merged, ["_g"], ["_t", "_tag", "_o", "_pid"], "_v", "_vf")
    hit = (F.col("_g").isNotNull() & F.col("_t").isNotNull() & F.col("_vf").isNotNull()
           & (F.col(f"_vf.{valid_to}").isNull() | (F.col("_t") < F.col(f"_vf.{valid_to}"))))
    out = filled.where(F.col("_tag") == 1)
    return out.select(*[F.col(held.get(c, f"_p.`{c}`")).alias(c) for c in probes.columns], *[F.when(hit, F.col(f"_vf.{c}")).alias(c) for c in take])


def customer_keys(requests: DataFrame, customers_ok: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """F1 + F2 as ``id, customer_key``: request -> persona of its customer row
    -> version valid at the request time (the historic version, not the
    customer row itself). Only ids, personas and times are moved."""
    return _with_customer_key(requests.select("id", "customer_id", "request_datetime"), customers_ok,
                              customer_dim).select("id", "customer_key")


def _with_customer_key(requests: DataFrame, customers_ok: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Requests of one customer row at one time have one key: it is looked up
    once for all of them, and only customer ids, personas and times are moved."""
    persona = customers_ok.select(F.col("id").alias("_cid"), F.col("fiscal_code_hash").alias("_persona"))
    probes = (requests.select(F.col("customer_id").alias("_c"), F.col("request_datetime").alias("_at")).distinct()
              .join(persona, F.col("_c") == F.col("_cid"), "left").select("_c", "_at", "_persona"))
    dim = customer_dim.select("fiscal_code_hash", "valid_from", "valid_to", "customer_key")
    keys = asof_join(probes, dim, "_persona", "_at", "fiscal_code_hash",
                     take=["customer_key"], version_order=["customer_key"]).select("_c", "_at", "customer_key")
    return requests.join(keys, F.col("customer_id").eqNullSafe(F.col("_c"))
                         & F.col("request_datetime").eqNullSafe(F.col("_at")), "left").drop("_c", "_at")


def resolve_customer_key(requests: DataFrame, customers_ok: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """The requests with their ``customer_key``."""
    return _with_customer_key(requests, customers_ok, customer_dim)


def asof_cardinality(resolved: DataFrame, key_col: str = "customer_key") -> DataFrame:
    """probes without exactly one version (one row ``n_probes, n_matched,
    n_unmatched``); the load fails when ``n_unmatched > 0``."""
    return resolved.agg(
        F.count(F.lit(1)).alias("n_probes"),
        F.count(key_col).alias("n_matched"),
        F.count(F.when(F.col(key_col).isNull(), 1)).alias("n_unmatched"),
    )


def asof_matches(probes: DataFrame, versions: DataFrame, probe_group: str, probe_ts: str, version_group: str,
                 valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """``probes`` with ``n_matches``, the number of versions of their group
    that hold their time; the intervals may overlap in any way.

    An interval adds one at its start and takes one at its end, so a probe's
    count is a running sum; no pairs are formed, and a hot group is cut into
    segments."""
    real = F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))
    v = versions.where(F.col(version_group).isNotNull() & F.col(valid_from).isNotNull() & real)
    p = probes.select(F.struct(*probes.columns).alias("_p"), F.col(probe_group).alias("_g"), F.col(probe_ts).alias("_t"),
                      F.lit(1).alias("_after"), F.lit(0).cast("bigint").alias("_d"))
    nobody = F.lit(None).cast(p.schema["_p"].dataType).alias("_p")
    edge = lambda c, d: v.where(F.col(c).isNotNull()).select(
        nobody, F.col(version_group).alias("_g"), F.col(c).alias("_t"), F.lit(0).alias("_after"),
        F.lit(d).cast("bigint").alias("_d"))
    merged = (p.where(F.col("_g").isNotNull() & F.col("_t").isNotNull())
              .unionByName(edge(valid_from, 1)).unionByName(edge(valid_to, -1)))
    counted = running_sum_in_group(merged, ["_g"], ["_t", "_after"], "_d", "n_matches").where(F.col("_after") == 1)
    without = p.where(F.col("_g").isNull() | F.col("_t").isNull())
    return (counted.select("_p.*", "n_matches")
            .unionByName(without.select("_p.*", F.lit(0).cast("bigint").alias("n_matches"))))


def asof_match_classes(matched: DataFrame) -> DataFrame:
    """probes with no, one, or several versions; a load needs exactly one."""
    kind = F.when(F.col("n_matches") == 0, "none").when(F.col("n_matches") == 1, "one").otherwise("several")
    return matched.groupBy(kind.alias("matches")).agg(F.count(F.lit(1)).alias("n_probes"))


def build_request_fact(requests_ok: DataFrame, customers_ok: DataFrame, customer_dim: DataFrame,
                       supplier_dim: DataFrame, operator_dim: DataFrame) -> DataFrame:
    """One fact row per valid request, 14 columns in fixed order."""
    r = resolve_customer_key(requests_ok, customers_ok, customer_dim)
    sk = supplier_dim.select(F.col("supplier_id").alias("_sid"), "supplier_key")
    ok = operator_dim.select(F.col("operator_id").alias("_oid"), "operator_key")
    r = (r.join(sk, r["supplier_id"] == sk["_sid"], "left").drop("_sid")
          .join(ok, r["operator_id"] == ok["_oid"], "left").drop("_oid"))
    status = F.col("status")
    return r.select(
        F.col("id").cast("bigint").alias("request_id"),
        F.col("customer_key").cast("bigint"),
        F.col("supplier_key").cast("bigint"),
        F.col("operator_key").cast("bigint"),
        date_key("request_datetime").alias("date_key"),
        F.col("price").cast("double"),
        F.col("service_duration_minutes").cast("int"),
        F.when(status.isin("completed", "invoiced"), 1).otherwise(0).alias("is_completed"),
        F.when(status == "cancelled", 1).otherwise(0).alias("is_cancelled"),
        status.alias("status"),
        fact_hash("customer_id", "supplier_id", "operator_id", "request_datetime", "price").alias("hash_record"),
        F.col("request_datetime"),
        F.col("completed_datetime"),
        F.col("notes").cast("string"),
    ).select(*FACT_COLUMNS)


def fact_hash(customer_id: str, supplier_id: str, operator_id: str, ts: str, price: str):
    """source ids, ISO timestamp and ``%.2f`` price, joined by '|', SHA-256."""
    return hash_record(customer_id, supplier_id, operator_id, ts_text(ts), money_text(price))


def hash_uniqueness(fact: DataFrame, hash_col: str = "hash_record") -> DataFrame:
    """rows, distinct hashes and their ratio (reported, not enforced).
    The fact is read twice (see ``distinct_counts``)."""
    return distinct_counts(fact, hash_col).withColumnRenamed("n_distinct", "n_distinct_hash").withColumn(
        "distinct_ratio", F.col("n_distinct_hash").cast("double") / F.nullif(F.col("n_rows"), F.lit(0)))


def dedup_by_hash(fact: DataFrame, hash_col: str = "hash_record", id_col: str = "request_id") -> DataFrame:
    """keep the row with the smallest id of each hash. The rank filter
    becomes a group limit before the shuffle too, so a hash shared by very
    many copies leaves one row per task."""
    first = Window.partitionBy(hash_col).orderBy(F.col(id_col).asc_nulls_last())
    return fact.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")
