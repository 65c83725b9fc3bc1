"""The load: entities -> validation -> gate -> dimensions -> fact -> checks
-> warehouse. Everything is a lazy DataFrame until the gate action; the
reject counts are taken once, before anything is written."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import CALENDAR_END, CALENDAR_START, REJECT_RATIO_LIMIT
from ..model import WAREHOUSE_SCHEMAS, Star
from ..operators import validation as V
from ..operators.aggregates import Aggregates, base_rows, build_measures, build_persona_bitmaps, tasks_for
from ..operators.dims import (build_customer_dim_scd2, build_operator_dim, build_supplier_dim,
                              build_time_dim, calendar_days)
from ..operators.checks import ForeignKeyViolation, enforce_fks, schema_matches
from ..operators.fact import asof_matches, build_request_fact
from ..operators.intervals import overlapping
from ..operators.states import filter_unreachable
from ..session import cut_lineage, released_shuffles, stored
from ..sources import csv as CSV
from ..sources import driver
from ..sources.driver import RuleConfig
from .versions import DONE, complete_versions, current_version, prune_versions, read_fact, write_fact  # noqa: F401


@dataclass(frozen=True)
class Loaded:
    validated: V.Validated
    summary: DataFrame
    customer_dim: DataFrame
    supplier_dim: DataFrame
    operator_dim: DataFrame
    time_dim: DataFrame
    fact: DataFrame
    calendar: tuple[dt.date, dt.date]

    def star(self) -> Star:
        return Star(self.fact, self.time_dim, self.customer_dim, self.supplier_dim, self.operator_dim,
                    calendar_days(*self.calendar))


def build(customers: DataFrame, suppliers: DataFrame, operators: DataFrame, requests: DataFrame,
          cfg: RuleConfig | None = None, calendar: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END),
          gate_limit: float | None = REJECT_RATIO_LIMIT, malformed: DataFrame | None = None) -> Loaded:
    """Validate, gate (when ``gate_limit`` is not None) and build the star.
    ``malformed``: quarantine rows of lines that could not be read; they count
    as read and rejected."""
    spark = customers.sparkSession
    val = V.validate_all(customers, suppliers, operators, requests, cfg)
    if malformed is not None:
        val = val.with_rejected(malformed)
    # M5: statuses the state machine cannot reach are rejected too, and counted.
    val = val.map_requests(filter_unreachable)
    summary = V.validation_summary(val.totals, val.quarantine,
                                   REJECT_RATIO_LIMIT if gate_limit is None else gate_limit)
    if gate_limit is not None:
        V.enforce_gate(summary)
    cdim = build_customer_dim_scd2(val.customers_ok)
    sdim = build_supplier_dim(val.suppliers_ok)
    odim = build_operator_dim(val.operators_ok)
    tdim = build_time_dim(spark, *calendar)
    fact = build_request_fact(val.requests_ok, val.customers_ok, cdim, sdim, odim)
    return Loaded(val, summary, cdim, sdim, odim, tdim, fact, calendar)


def validated_driver(spark: SparkSession, sf_dir: str) -> V.Validated:
    return V.validate_all(driver.customers_entity(spark, sf_dir), driver.suppliers_entity(spark, sf_dir),
                          driver.operators_entity(spark, sf_dir), driver.requests_entity(spark, sf_dir),
                          driver.driver_rules())


def load_driver(spark: SparkSession, sf_dir: str, gate_limit: float | None = None) -> Loaded:
    """The load over the driver tables. Their reject ratios are far above the
    source system's 5 % (duplicate line keys), so the gate is reported, not
    enforced, unless a limit is given."""
    return build(driver.customers_entity(spark, sf_dir), driver.suppliers_entity(spark, sf_dir),
                 driver.operators_entity(spark, sf_dir), driver.requests_entity(spark, sf_dir),
                 driver.driver_rules(), driver.DRIVER_CALENDAR, gate_limit)


def load_csv(spark: SparkSession, folder: str, warehouse: str, cfg: RuleConfig | None = None,
             calendar: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END),
             gate_limit: float | None = REJECT_RATIO_LIMIT) -> DataFrame:
    """The whole load: ``customers.csv``, ``suppliers.csv``, ``operators.csv``
    and ``requests.csv`` of ``folder`` into ``warehouse``. Malformed lines go
    to the quarantine and count for the gate. Returns one row per entity:
    ``table, n_read, n_rejected, n_inserted``."""
    good, malformed = {}, None
    for e in CSV.SCHEMAS:
        # the rules and the quarantine read them: parsed once
        lines = stored(CSV.read_entity(spark, f"{folder.rstrip('/')}/{e}.csv", e, keep_corrupt=True), "lines")
        good[e], bad = CSV.split_corrupt(lines, e)
        malformed = bad if malformed is None else malformed.unionByName(bad)
    loaded = build(good["customers"], good["suppliers"], good["operators"], good["requests"], cfg, calendar,
                   gate_limit, malformed)
    report = cut_lineage(loaded.summary)  # before the write releases the rule results
    write_warehouse(loaded, warehouse)
    star, inserted = read_warehouse(spark, warehouse), None
    for table, rows in (("customers", star.customer_dim), ("suppliers", star.supplier_dim),
                          ("operators", star.operator_dim), ("requests", star.fact)):
        n = rows.select(F.lit(table).alias("table"))
        inserted = n if inserted is None else inserted.unionByName(n)
    counts = inserted.groupBy("table").agg(F.count(F.lit(1)).alias("n_inserted"))
    return report.join(counts, "table", "left").select(
        "table", F.col("n_total").alias("n_read"), F.col("n_ko").alias("n_rejected"),
        F.coalesce("n_inserted", F.lit(0)).cast("bigint").alias("n_inserted"))


class UnresolvedVersion(RuntimeError):
    pass


class AmbiguousVersion(RuntimeError):
    pass


def check_single_versions(loaded: Loaded) -> None:
    """no request has two customer versions at its time. Only the requests
    of personas whose versions overlap (none, if the dimension was built here)
    are counted against them."""
    clashing = cut_lineage(overlapping(loaded.customer_dim, "fiscal_code_hash"))
    if clashing.isEmpty():
        return
    persona = loaded.validated.customers_ok.join(clashing, "fiscal_code_hash", "left_semi").select(
        F.col("id").alias("customer_id"), "fiscal_code_hash")
    probes = loaded.validated.requests_ok.select("id", "customer_id", "request_datetime").join(persona, "customer_id")
    found = asof_matches(probes, loaded.customer_dim.join(clashing, "fiscal_code_hash", "left_semi"),
                         "fiscal_code_hash", "request_datetime", "fiscal_code_hash").where("n_matches > 1")
    told = found.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).first()
    if told.n:
        raise AmbiguousVersion(f"{told.n} requests have several customer versions at their time, for example {told.id}")


def check_fact_keys(loaded: Loaded, fact: DataFrame | None = None) -> None:
    """F3 + S12 before the fact is written: every request found exactly one
    customer version, no key is NULL, and no foreign key is orphaned. Each
    action collects one small row per check."""
    check_single_versions(loaded)
    fact = loaded.fact if fact is None else fact
    keys = ("customer_key", "supplier_key", "operator_key", "date_key")
    nulls = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in keys]).collect()[0]
    if nulls["customer_key"]:
        raise UnresolvedVersion(f"{nulls['customer_key']} requests have no customer version at their time")
    if any(nulls[c] for c in keys):
        raise ForeignKeyViolation(", ".join(f"{c}: {nulls[c]} NULL" for c in keys if nulls[c]))
    enforce_fks(fact, [("customer_key", loaded.customer_dim, "customer_key"),
                       ("supplier_key", loaded.supplier_dim, "supplier_key"),
                       ("operator_key", loaded.operator_dim, "operator_key"),
                       ("date_key", loaded.time_dim, "date_key")])


def write_warehouse(loaded: Loaded, path: str, check: bool = True, max_records_per_file: int = 5_000_000,
                    release: bool = True) -> dict[str, str]:
    """A full rebuild into a new version folder under ``path``; its
    last write is the marker that makes it complete. Readers take the newest
    complete version: there is no moment without one, and a rebuild that is
    lost half-way is never seen. Readers that already hold the previous
    version keep reading it until ``prune_versions``; a rebuild from the same
    input gives the same tables, and writes no month of the fact again.

    Dimensions are written first, then the months of the fact that changed,
    sorted by ``date_key`` inside the files (Parquet min/max statistics prune
    periods). The fact is range-partitioned on ``(date_key, request_id)``, so
    a month or even one hot day is written by several tasks, each writing a
    contiguous date range. With ``check`` the fact keys are verified first
    (F3, S12). Without ``release`` the rule results stay kept, for another
    write of the same load."""
    spark = loaded.fact.sparkSession
    try:
        check_contract(loaded)
        with released_shuffles(spark):
            # the fact feeds the key checks, the digests and the write: it is made once
            return _write_version(loaded, stored(loaded.fact, "fact"), path, check, max_records_per_file)
    finally:
        if release:
            loaded.validated.release()


def _write_version(loaded: Loaded, fact: DataFrame, path: str, check: bool, max_records_per_file: int) -> dict[str, str]:
    spark = fact.sparkSession
    if check:
        check_fact_keys(loaded, fact)
    version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    base = f"{path.rstrip('/')}/v={version}"
    out = {}
    for name, df in (("time_dim", loaded.time_dim), ("customer_dim", loaded.customer_dim),
                     ("supplier_dim", loaded.supplier_dim), ("operator_dim", loaded.operator_dim)):
        df.write.mode("errorifexists").parquet(f"{base}/{name}")
        out[name] = f"{base}/{name}"
    write_fact(fact.withColumn("date_month", (F.col("date_key") / 100).cast("int")), path, base, max_records_per_file)
    out["request_fact"] = f"{base}/fact_manifest"
    loaded.validated.quarantine.write.mode("errorifexists").parquet(f"{base}/quarantine")
    out["quarantine"] = f"{base}/quarantine"
    # the marker: whether the keys were verified; Spark adds _SUCCESS last
    spark.createDataFrame([("true" if check else "false",)], "fk_checked string") \
         .coalesce(1).write.mode("errorifexists").json(f"{base}/{DONE}")
    return out


def write_aggregates(star: Star, base: str, period: tuple[dt.date, dt.date]) -> None:
    """The stored aggregates of ``star`` over ``period``, under the version
    folder ``base``, by month so that a period prunes folders. Its last write
    is the marker with the period."""
    rows = base_rows(star, period).persist(StorageLevel.MEMORY_AND_DISK)  # read by both tables
    try:
        tasks = tasks_for(rows)
        build_measures(rows, tasks).write.mode("errorifexists").partitionBy("date_month").parquet(f"{base}/agg_measures")
        build_persona_bitmaps(rows, period, tasks).write.mode("errorifexists").partitionBy("level").parquet(f"{base}/agg_personas")
    finally:
        rows.unpersist(blocking=False)
    star.fact.sparkSession.createDataFrame([tuple(d.isoformat() for d in period)], "first string, last string") \
        .coalesce(1).write.mode("errorifexists").json(f"{base}/agg_complete")


def read_aggregates(spark: SparkSession, base: str) -> Aggregates | None:
    """The aggregates of a version folder; None if it has none (or not all)."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/agg_complete/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return None
    row = spark.read.schema("first string, last string").json(f"{base}/agg_complete").first()
    return Aggregates(spark.read.parquet(f"{base}/agg_measures"), spark.read.parquet(f"{base}/agg_personas"),
                      spark.read.parquet(f"{base}/supplier_dim"),
                      (dt.date.fromisoformat(row["first"]), dt.date.fromisoformat(row["last"])))


class ContractViolation(RuntimeError):
    pass


def check_contract(loaded: Loaded) -> None:
    """Names and types of the five tables, before anything is written."""
    for name, expected in WAREHOUSE_SCHEMAS.items():
        df = loaded.fact if name == "request_fact" else getattr(loaded, name)
        if not schema_matches(df, expected):
            raise ContractViolation(f"{name}: {df.schema.simpleString()} is not {expected.simpleString()}")


def read_warehouse(spark: SparkSession, path: str, calendar: tuple[dt.date, dt.date] | None = None) -> Star:
    """The current version of the star back from Parquet; ``date_month``
    stays a partition column so K0's period predicate prunes directories."""
    base, checked = current_version(spark, path)
    fact = read_fact(spark, path, base, WAREHOUSE_SCHEMAS["request_fact"])
    return Star(fact, spark.read.parquet(f"{base}/time_dim"), spark.read.parquet(f"{base}/customer_dim"),
                spark.read.parquet(f"{base}/supplier_dim"), spark.read.parquet(f"{base}/operator_dim"),
                calendar_days(*calendar) if calendar else None, fk_checked=checked)
