"""Data-quality checks on the loaded star.

Each check is a small aggregate DataFrame with its numbers and an ``ok``
column; :func:`as_result` turns it into the uniform ``name, ok, message`` row
and :func:`report` unions them (Q9). Nothing is collected except by the
caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import KpiParams, Star
from . import kpis
from .sketch import distinct_counts

DAILY_LABEL = r"^\d{4}-\d{2}-\d{2}$"
WEEKLY_LABEL = r"^\d{4}-W\d{2}$"


def merge_one_row(**frames: tuple[DataFrame, str, str]) -> DataFrame:
    """Put the values of several one-row aggregates side by side without a
    join: each ``name=(frame, column, type)`` becomes one tagged row of a
    union (values as double: exact for counts below 2**53), folded back into
    one row by a single aggregation."""
    parts = [df.select(F.lit(name).alias("_name"), F.col(col).cast("double").alias("_v"))
             for name, (df, col, _) in frames.items()]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    return u.agg(*[F.max(F.when(F.col("_name") == name, F.col("_v"))).cast(typ).alias(name)
                   for name, (_, _, typ) in frames.items()])


def as_result(df: DataFrame, name: str, message: Column) -> DataFrame:
    """Q9 envelope of a one-row check."""
    return df.select(F.lit(name).alias("name"), F.col("ok").cast("boolean").alias("ok"),
                     message.cast("string").alias("message"))


def report(results: Iterable[DataFrame]) -> DataFrame:
    """Q9: all check rows plus the passed count on every row."""
    rs = list(results)
    out = rs[0]
    for r in rs[1:]:
        out = out.unionByName(r)
    everything = Window.partitionBy()  # one row per check: a handful of rows
    return out.select("*", F.count(F.lit(1)).over(everything).alias("n_checks"),
                      F.count_if(F.col("ok")).over(everything).alias("n_passed"))


# ---------------------------------------------------------------- S6, S11, S12

def source_profile(sources: dict[str, DataFrame], ts_table: str = "requests",
                   ts_col: str = "request_datetime") -> DataFrame:
    """Rows read per source; min / max of the request timestamp."""
    parts = [df.select(F.lit(name).alias("source"), F.lit(None).cast(df.schema[ts_col].dataType
                                                                        if name == ts_table else "timestamp_ntz").alias("_t"))
             if name != ts_table else df.select(F.lit(name).alias("source"), F.col(ts_col).alias("_t"))
             for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=False)
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.min("_t").alias("min_ts"),
                                   F.max("_t").alias("max_ts"))


def not_null_unique(df: DataFrame, table: str, not_null: Sequence[str], key: Sequence[str],
                    unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """S11 constraint check: NULLs in NOT NULL columns, duplicated primary keys
    and duplicated UNIQUE column sets (one row per table)."""
    # one grouping by the key serves the row count, the NULLs and the duplicates
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                   sum((F.count_if(F.col(c).isNull()) for c in not_null), F.lit(0)).alias("_nv"))
    main = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("_nv"), F.lit(0)).alias("nv"),
                       F.count_if(F.col("_n") > 1).alias("d"))

    def dup_groups(cols):
        return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                  .agg(F.count(F.lit(1)).alias("d")))

    frames = {"n_rows": (main, "n_rows", "bigint"), "null_violations": (main, "nv", "bigint"),
              "dup_keys": (main, "d", "bigint")}
    for i, cols in enumerate(unique):
        frames[f"_u{i}"] = (dup_groups(cols), "d", "bigint")
    out = merge_one_row(**frames) if unique else main.select("n_rows", F.col("nv").alias("null_violations"),
                                                             F.col("d").alias("dup_keys"))
    dup_unique = sum((F.col(f"_u{i}") for i in range(len(unique))), F.lit(0)).cast("bigint")
    return out.select(F.lit(table).alias("table"), "n_rows", "null_violations", "dup_keys",
                      dup_unique.alias("dup_unique"),
                      ((F.col("null_violations") == 0) & (F.col("dup_keys") == 0) & (dup_unique == 0)).alias("ok"))


def schema_matches(df: DataFrame, expected: T.StructType) -> bool:
    """S11 type part: names and types equal (nullability is a data check)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    return got == [(f.name, f.dataType) for f in expected.fields]


def fk_orphans(fact: DataFrame, fks: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Per foreign key, fact rows whose non-NULL key is not in the
    dimension (``NOT IN`` semantics: NULL keys are not orphans)."""
    rows = []
    for col, dim, dim_key in fks:
        keys = dim.select(F.col(dim_key).alias("_k")).distinct()
        orphans = (fact.where(F.col(col).isNotNull())
                       .join(keys, F.col(col) == F.col("_k"), "left_anti")
                       .agg(F.count(F.lit(1)).alias("orphans")))
        rows.append(orphans.select(F.lit(col).alias("fk"), "orphans"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("ok", F.col("orphans") == 0)


class ForeignKeyViolation(RuntimeError):
    pass


def enforce_fks(fact: DataFrame, fks: Sequence[tuple[str, DataFrame, str]]) -> None:
    """S12 at load time: fail before the fact is written when any key is
    orphaned (collects one row per foreign key)."""
    bad = [r for r in fk_orphans(fact, fks).collect() if not r["ok"]]
    if bad:
        raise ForeignKeyViolation(", ".join(f"{r['fk']}: {r['orphans']}" for r in bad))


# ---------------------------------------------------------------- Q1, Q3-Q5, Q8

def row_counts(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Q1: per table actual rows against ``expected (table, expected)``."""
    parts = [df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(n).alias("table"), "actual")
             for n, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.join(expected, "table", "full")
             .withColumn("ok", F.coalesce(F.col("actual") == F.col("expected"), F.lit(False))))


def scd2_check(customer_dim: DataFrame, persona: str = "fiscal_code_hash") -> DataFrame:
    """Q3: current rows, personas, personas with more than one current row."""
    per = customer_dim.groupBy(persona).agg(F.sum("is_current").alias("_cur"))
    return per.agg(
        F.coalesce(F.sum("_cur"), F.lit(0)).cast("bigint").alias("n_current"),
        F.count(F.lit(1)).alias("n_personas"),
        F.count_if(F.col("_cur") > 1).alias("n_multi_current"),
    ).withColumn("ok", (F.col("n_multi_current") == 0) & (F.col("n_current") == F.col("n_personas")))


def calendar_check(time_dim: DataFrame) -> DataFrame:
    """Q4 + Q10: no duplicate date and max - min + 1 = rows; also returns the
    canonical period (min, max)."""
    a = time_dim.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("full_date").alias("n_dates"),
                     F.min("full_date").alias("first_date"), F.max("full_date").alias("last_date"))
    span = F.datediff("last_date", "first_date") + 1
    return a.withColumn("ok", F.coalesce((F.col("n_rows") == F.col("n_dates")) & (span == F.col("n_rows")),
                                         F.col("n_rows") == 0))


def hash_unique_check(fact: DataFrame, hash_col: str = "hash_record") -> DataFrame:
    """Q5: rows = distinct hashes. The fact is read twice."""
    return distinct_counts(fact, hash_col).withColumn("ok", F.col("n_rows") == F.col("n_distinct"))


def share_check(df: DataFrame, col: str, expected: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Q8: share of each value vs ``expected`` ``(value, target, tolerance)``;
    a missing value counts as share 0; an empty table fails every row.

    One pass: a conditional count per expected value plus the total, then the
    row is unpivoted into one row per expected value."""
    counts = df.agg(F.count(F.lit(1)).alias("_total"),
                    *[F.count_if(F.col(col) == F.lit(v)).alias(f"_c{i}") for i, (v, _, _) in enumerate(expected)])
    stacked = counts.select("_total", F.explode(F.array(*[
        F.struct(F.lit(v).alias("value"), F.col(f"_c{i}").cast("bigint").alias("n"),
                 F.lit(float(t)).alias("target"), F.lit(float(tol)).alias("tolerance"))
        for i, (v, t, tol) in enumerate(expected)])).alias("_e"))
    j = stacked.select("_total", "_e.*").withColumn(
        "share", F.when(F.col("_total") > 0, F.col("n") / F.col("_total")))
    return j.select("value", "n", "share", "target", "tolerance",
                    F.coalesce(F.abs(F.col("share") - F.col("target")) <= F.col("tolerance"),
                               F.lit(False)).alias("ok"))


# ---------------------------------------------------------------- Q11-Q14 (KPI invariants)

def kpi_reconcile(star: Star, p: KpiParams, eps: float = 1e-6) -> DataFrame:
    """Q11: KPI 6 x KPI 1 = number of cancelled rows (within ``eps``)."""
    base = kpis.filtered_star(star, p, (), ())
    n_c = base.agg(F.coalesce(F.sum("is_cancelled"), F.lit(0)).cast("bigint").alias("n_cancelled"))
    return (merge_one_row(k1=(kpis.kpi_request_count(star, p), "value", "bigint"),
                          k6=(kpis.kpi_cancel_rate(star, p), "value", "double"),
                          n_cancelled=(n_c, "n_cancelled", "bigint"))
              .withColumn("ok", F.coalesce(F.abs(F.col("k6") * F.col("k1") - F.col("n_cancelled")) <= eps,
                                           F.col("k1") == 0)))


def ratio_range(star: Star, p: KpiParams) -> DataFrame:
    """Q12: 0 <= KPI 6, KPI 7 <= 1 (NULL on an empty set passes)."""
    both = merge_one_row(cancel_rate=(kpis.kpi_cancel_rate(star, p), "value", "double"),
                         retention=(kpis.kpi_retention(star, p), "value", "double"))
    ok = (F.coalesce(F.col("cancel_rate").between(0, 1), F.col("cancel_rate").isNull())
          & F.coalesce(F.col("retention").between(0, 1), F.col("retention").isNull()))
    return both.withColumn("ok", ok)


def label_format(trend: DataFrame, granularity: str) -> DataFrame:
    """Q13: every label matches the daily or weekly pattern."""
    pat = WEEKLY_LABEL if granularity == "weekly" else DAILY_LABEL
    return (trend.agg(F.count(F.lit(1)).alias("n_labels"),
                      F.count_if(~F.coalesce(F.col("period_label").rlike(pat), F.lit(False))).alias("n_bad"))
                 .withColumn("ok", F.col("n_bad") == 0))


def filter_monotonic(star: Star, p_all: KpiParams, p_filtered: KpiParams) -> DataFrame:
    """Q14: 0 < KPI 1 (filtered) < KPI 1 (all)."""
    both = merge_one_row(n_all=(kpis.kpi_request_count(star, p_all), "value", "bigint"),
                         n_filtered=(kpis.kpi_request_count(star, p_filtered), "value", "bigint"))
    return both.withColumn("ok", (F.col("n_filtered") > 0) & (F.col("n_filtered") < F.col("n_all")))


def star_checks(spark: SparkSession, star: Star, expected_rows: DataFrame | None = None) -> DataFrame:
    """Q9 over a loaded star: the structural checks as one report."""
    fact = star.fact
    results = [
        as_result(fk_orphans(fact, [("customer_key", star.customer_dim, "customer_key"),
                                    ("supplier_key", star.supplier_dim, "supplier_key"),
                                    ("date_key", star.time_dim, "date_key")]
                             + ([("operator_key", star.operator_dim, "operator_key")]
                                if star.operator_dim is not None else []))
                  .agg(F.sum("orphans").alias("orphans"))
                  .withColumn("ok", F.col("orphans") == 0),
                  "fk_orphans", F.format_string("orphans=%d", F.col("orphans"))),
        as_result(scd2_check(star.customer_dim), "scd2",
                  F.format_string("current=%d personas=%d multi_current=%d", "n_current", "n_personas",
                                  "n_multi_current")),
        as_result(calendar_check(star.time_dim), "calendar",
                  F.format_string("rows=%d distinct=%d", "n_rows", "n_dates")),
        as_result(hash_unique_check(fact), "hash_unique",
                  F.format_string("rows=%d distinct=%d", "n_rows", "n_distinct")),
    ]
    if expected_rows is not None:
        tables = {"time_dim": star.time_dim, "customer_dim": star.customer_dim,
                  "supplier_dim": star.supplier_dim, "request_fact": fact}
        if star.operator_dim is not None:
            tables["operator_dim"] = star.operator_dim
        rc = row_counts(tables, expected_rows).agg(F.count_if(~F.col("ok")).alias("bad"))
        results.append(as_result(rc.withColumn("ok", F.col("bad") == 0), "row_counts",
                                 F.format_string("tables_off=%d", "bad")))
    return report(results)
