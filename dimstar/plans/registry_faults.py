"""Registered load queries over entities that break every rule (V2-V26), with
historic customer versions (F2), duplicate content (F13), incoherent statuses
(D2), orphaned keys (Q2) and overlapping intervals (F3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import fact as FT
from ..operators import validation as V
from ..operators.dims import build_customer_dim_scd2, build_supplier_dim, scd2_coherence
from ..operators.intervals import interval_join
from ..session import scratch_path
from ..sources import csv as CSV
from ..sources import driver, driver_faults
from .load import build, load_csv
from .oracle_etl import with_etl

Q = '"table"'


def _entities(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [driver_faults.faulty_entity(spark, sf_dir, e) for e in ("customers", "suppliers", "operators", "requests")]


def _validated(spark, sf_dir) -> V.Validated:
    return V.validate_all(*_entities(spark, sf_dir), driver_faults.faulty_rules())


def _loaded(spark, sf_dir):
    return build(*_entities(spark, sf_dir), driver_faults.faulty_rules(), driver_faults.FAULTY_CALENDAR, None)


def _rules(table: str):
    return lambda spark, sf_dir: _validated(spark, sf_dir).quarantine_of(table)


def reject_profile_faults(spark, sf_dir):
    return V.reject_profile(_validated(spark, sf_dir).quarantine)


def scd2_coherence_faults(spark, sf_dir):
    v = _validated(spark, sf_dir)
    dim = build_customer_dim_scd2(v.customers_ok)
    status = v.customers_ok.select(F.col("id").alias("customer_id"), "status")
    return scd2_coherence(dim.join(status, "customer_id")).select("customer_id", "is_current", "status")


def asof_lookup_history(spark, sf_dir):
    v = _validated(spark, sf_dir)
    dim = build_customer_dim_scd2(v.customers_ok)
    return FT.customer_keys(v.requests_ok, v.customers_ok, dim).withColumnRenamed("id", "request_id")


def dedup_by_hash_faults(spark, sf_dir):
    return FT.dedup_by_hash(_loaded(spark, sf_dir).fact)


def fk_orphans_partial(spark, sf_dir):
    """The fact against dimensions that lack some of its keys."""
    v = _validated(spark, sf_dir)
    suppliers = build_supplier_dim(v.suppliers_ok).select("supplier_id")
    requests = v.requests_ok.select(F.col("supplier_id"), F.col("operator_id"))
    return C.fk_orphans(requests, [("supplier_id", suppliers.where("supplier_id % 7 <> 0"), "supplier_id"),
                                   ("operator_id", v.operators_ok.where("id % 11 <> 0"), "id")])


def _views(spark, sf_dir):
    """Overlapping intervals: a view opens one of as many hours as its value,
    every 50th without an end."""
    e = driver.table(spark, sf_dir, "events")
    return e.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("valid_from"),
        F.when(F.col("event_id") % 50 != 0, F.expr("ts + make_dt_interval(0, cast(floor(value) AS int))")).alias("valid_to"))


def asof_match_classes(spark, sf_dir):
    """F3 over overlapping intervals; purchases are the probes."""
    return FT.asof_match_classes(FT.asof_matches(driver.purchases(spark, sf_dir), _views(spark, sf_dir),
                                                 "user_id", "ts", "user_id"))


def asof_all_versions(spark, sf_dir):
    """F2 over overlapping intervals: every version that holds a probe's time;
    probes without any have no row."""
    pairs = interval_join(driver.purchases(spark, sf_dir), _views(spark, sf_dir), "user_id", "ts", "user_id")
    return pairs.select("probe.event_id", "version.view_id", "version.valid_from", "version.valid_to")


# --- CSV: reordered columns, ragged lines, bad values, and the load from files

def _text(df: DataFrame) -> DataFrame:
    return CSV.serialise(df).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def csv_round_trip_reordered(spark, sf_dir):
    """Columns are found by name: the file has them in reverse order."""
    path = scratch_path(spark, "csv-reordered")
    df = driver.suppliers_entity(spark, sf_dir)
    CSV.write_entity(df.select(*reversed(df.columns)), path)
    return CSV.read_entity(spark, path, "suppliers")


def csv_quarantine(spark, sf_dir):
    """Lines with a field too many or too few, or a value without its type."""
    path = scratch_path(spark, "csv-ragged")
    df = driver.requests_entity(spark, sf_dir)
    columns = _text(df)
    line = F.concat_ws(",", *columns.columns)
    n = F.col("id").cast("bigint")
    broken = (F.when(n % 7 == 1, F.concat(line, F.lit(",extra"))).when(n % 7 == 2, F.concat_ws(",", *columns.columns[:-1]))
              .when(n % 7 == 3, F.concat_ws(",", *[F.lit("garbage") if c in ("request_datetime", "price") else F.col(c)
                                                  for c in columns.columns])).otherwise(line))
    # every file starts with the header, like the files that Spark writes
    columns.select(broken.alias(",".join(columns.columns))).write.option("header", "true").option("quote", "") \
        .option("sep", "\u0001").csv(path)
    return CSV.read_entity(spark, path, "requests", keep_corrupt=True).where(F.col(CSV.CORRUPT).isNotNull()) \
        .select("id", F.col(CSV.CORRUPT).alias("malformed"))


def csv_round_trip_line_ends(spark, sf_dir):
    """Notes with line ends, quotes and commas: records over three lines."""
    path = scratch_path(spark, "csv-line-ends")
    df = driver.requests_entity(spark, sf_dir)
    notes = F.concat(F.lit('line "1", of '), F.col("id").cast("string"), F.lit("\n"), F.coalesce("notes", F.lit("")),
                     F.lit('\r\n"end", '), F.col("status"))
    CSV.write_entity(df.withColumn("notes", notes), path)
    return CSV.read_entity(spark, path, "requests")


def csv_load_report(spark, sf_dir):
    """The whole load from four CSV files into a warehouse."""
    folder = scratch_path(spark, "csv-load")
    for e, build_entity in (("customers", driver.customers_entity), ("suppliers", driver.suppliers_entity),
                            ("operators", driver.operators_entity), ("requests", driver.requests_entity)):
        CSV.write_entity(build_entity(spark, sf_dir), f"{folder}/{e}.csv")
    return load_csv(spark, folder, scratch_path(spark, "csv-warehouse"), driver.driver_rules(), driver.DRIVER_CALENDAR,
                    gate_limit=None)


def _faults(select: str, dims: bool = False) -> str:
    return with_etl(select, dims, entities=driver_faults.oracle_ctes())


SQL = {
    **{f"rules_{t}_faults": _faults(f"SELECT {Q}, key, reason FROM quarantine WHERE {Q} = '{t}'")
       for t in ("customers", "suppliers", "operators", "requests")},
    "reject_profile_faults": _faults(f"SELECT {Q}, reason, COUNT(*) AS n_rejected FROM quarantine GROUP BY {Q}, reason"),
    "scd2_coherence_faults": _faults("""
SELECT d.customer_id, d.is_current, c.status FROM cdim d JOIN c_ok c ON d.customer_id = c.id
WHERE (d.is_current = 1) <> COALESCE(c.status = 'active', FALSE)""", dims=True),
    "asof_lookup_history": _faults("SELECT id AS request_id, customer_key FROM r_key", dims=True),
    "dedup_by_hash_faults": _faults("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY hash_record ORDER BY request_id) AS rn FROM rfact) t
WHERE rn = 1""", dims=True),
    "fk_orphans_partial": _faults("""
SELECT 'supplier_id' AS fk, COUNT(*) AS orphans, COUNT(*) = 0 AS ok FROM r_ok
WHERE supplier_id NOT IN (SELECT supplier_id FROM sdim WHERE supplier_id % 7 <> 0)
UNION ALL
SELECT 'operator_id', COUNT(*), COUNT(*) = 0 FROM r_ok WHERE operator_id NOT IN (SELECT id FROM o_ok WHERE id % 11 <> 0)""",
                                  dims=True),
    "asof_match_classes": """
WITH v AS (SELECT user_id, ts AS valid_from,
                  CASE WHEN event_id % 50 <> 0 THEN ts + to_hours(CAST(floor(value) AS INTEGER)) END AS valid_to
           FROM events WHERE event_type = 'view'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
m AS (SELECT p.event_id, COUNT(v.valid_from) AS n FROM p LEFT JOIN v ON v.user_id = p.user_id AND v.valid_from <= p.ts
      AND (v.valid_to IS NULL OR p.ts < v.valid_to) GROUP BY p.event_id)
SELECT CASE WHEN n = 0 THEN 'none' WHEN n = 1 THEN 'one' ELSE 'several' END AS matches, COUNT(*) AS n_probes
FROM m GROUP BY 1""",
    "asof_all_versions": """
WITH v AS (SELECT user_id, event_id AS view_id, ts AS valid_from,
                  CASE WHEN event_id % 50 <> 0 THEN ts + to_hours(CAST(floor(value) AS INTEGER)) END AS valid_to
           FROM events WHERE event_type = 'view')
SELECT p.event_id, v.view_id, v.valid_from, v.valid_to FROM events p JOIN v ON v.user_id = p.user_id AND v.valid_from <= p.ts
  AND (v.valid_to IS NULL OR p.ts < v.valid_to) WHERE p.event_type = 'purchase'""",
    "csv_round_trip_reordered": with_etl("SELECT * FROM suppliers"),
    "csv_round_trip_line_ends": with_etl("""
SELECT * REPLACE ('line "1", of ' || CAST(id AS VARCHAR) || chr(10) || COALESCE(notes, '') || chr(13) || chr(10)
                  || '"end", ' || status AS notes) FROM requests"""),
    "csv_quarantine": with_etl("""
SELECT id, CASE WHEN id % 7 = 3 THEN 'request_datetime,price' ELSE 'fields' END AS malformed
FROM requests WHERE id % 7 IN (1, 2, 3)"""),
    "csv_load_report": with_etl(f"""
SELECT t.{Q}, t.n_total AS n_read, COALESCE(k.n, 0) AS n_rejected, t.n_total - COALESCE(k.n, 0) AS n_inserted
FROM totals t LEFT JOIN (SELECT {Q}, COUNT(*) AS n FROM quarantine GROUP BY {Q}) k ON t.{Q} = k.{Q}"""),
}

BUILDERS = {
    **{f"rules_{t}_faults": _rules(t) for t in ("customers", "suppliers", "operators", "requests")},
    "reject_profile_faults": reject_profile_faults,
    "scd2_coherence_faults": scd2_coherence_faults,
    "asof_lookup_history": asof_lookup_history,
    "dedup_by_hash_faults": dedup_by_hash_faults,
    "fk_orphans_partial": fk_orphans_partial,
    "asof_match_classes": asof_match_classes,
    "asof_all_versions": asof_all_versions,
    "csv_round_trip_reordered": csv_round_trip_reordered,
    "csv_round_trip_line_ends": csv_round_trip_line_ends,
    "csv_quarantine": csv_quarantine,
    "csv_load_report": csv_load_report,
}


def entries() -> dict:
    return {name: (b, SQL[name]) for name, b in BUILDERS.items()}
