"""Registered data-quality checks, the calendar, and KPIs over the loaded star."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.constants import DAY_NAMES_IT, EASTER_DATES_IT, FIXED_HOLIDAYS_IT, MONTH_NAMES_IT
from ..model import KpiParams
from ..operators import checks as C
from ..operators import kpis
from ..operators.dims import build_customer_dim_scd2, build_time_dim_covering
from ..session import stored
from ..sources import driver
from .load import load_driver, validated_driver
from .oracle_etl import with_etl
from .oracle_star import base_cte
from .registry import FULL, PROVINCE, SHORT

# ------------------------------------------------------------------ Spark side

SHARE_TARGETS = [("booked", 1 / 6), ("confirmed", 1 / 6), ("completed", 1 / 6), ("invoiced", 1 / 6),
                 ("cancelled", 1 / 3)]
SHARE_TOLERANCE = 0.02


def time_dim_q(spark, sf_dir):
    return build_time_dim_covering(driver.table(spark, sf_dir, "orders"), "o_orderdate")


def check_calendar(spark, sf_dir):
    return C.calendar_check(time_dim_q(spark, sf_dir))


def _fks(loaded):
    return [("customer_key", loaded.customer_dim, "customer_key"),
            ("supplier_key", loaded.supplier_dim, "supplier_key"),
            ("operator_key", loaded.operator_dim, "operator_key"),
            ("date_key", loaded.time_dim, "date_key")]


def check_fk_orphans(spark, sf_dir):
    loaded = load_driver(spark, sf_dir)
    fks = _fks(loaded)
    return C.fk_orphans(stored(loaded.fact.select(*[c for c, _, _ in fks]), "keys"), fks)  # every key reads it


def check_scd2(spark, sf_dir):
    return C.scd2_check(build_customer_dim_scd2(validated_driver(spark, sf_dir).customers_ok))


def check_hash_unique(spark, sf_dir):
    return C.hash_unique_check(stored(load_driver(spark, sf_dir).fact.select("hash_record"), "hashes"))


def check_status_share(spark, sf_dir):
    exp = [(v, t, SHARE_TOLERANCE) for v, t in SHARE_TARGETS]
    return C.share_check(driver.driver_star(spark, sf_dir).fact, "status", exp)


def check_kpi_reconcile(spark, sf_dir):
    return C.kpi_reconcile(driver.driver_star(spark, sf_dir), KpiParams.of(*FULL))


def check_ratio_range(spark, sf_dir):
    return C.ratio_range(driver.driver_star(spark, sf_dir), KpiParams.of(*FULL))


def check_labels(spark, sf_dir):
    star = driver.driver_star(spark, sf_dir)
    daily = C.label_format(kpis.trend_daily(star, KpiParams.of(*SHORT)), "daily") \
             .select(F.lit("daily").alias("granularity"), "*")
    weekly = C.label_format(kpis.trend_weekly(star, KpiParams.of(*FULL)), "weekly") \
              .select(F.lit("weekly").alias("granularity"), "*")
    return daily.unionByName(weekly)


def check_filter_monotonic(spark, sf_dir):
    return C.filter_monotonic(driver.driver_star(spark, sf_dir), KpiParams.of(*FULL),
                              KpiParams.of(*FULL, province=PROVINCE))


def source_profile(spark, sf_dir):
    return C.source_profile({
        "customers": driver.customers_entity(spark, sf_dir),
        "suppliers": driver.suppliers_entity(spark, sf_dir),
        "operators": driver.operators_entity(spark, sf_dir),
        "requests": driver.requests_entity(spark, sf_dir),
    })


NOT_NULL = {
    "request_fact": (["request_id", "customer_key", "supplier_key", "operator_key", "date_key", "price",
                      "is_completed", "is_cancelled", "status", "hash_record", "request_datetime"],
                     ["request_id"], []),
    "customer_dim": (["customer_key", "customer_id", "last_name", "first_name", "fiscal_code_hash",
                      "birth_date", "city", "province", "zip_code", "has_marketing_consent",
                      "registration_datetime", "valid_from", "is_current"], ["customer_key"], []),
    "supplier_dim": (["supplier_key", "supplier_id", "name", "category", "vat_number", "city", "province",
                      "zip_code", "is_active"], ["supplier_key"], []),
    "operator_dim": (["operator_key", "operator_id", "last_name", "first_name", "activity_type",
                      "hire_date", "status"], ["operator_key"], []),
    "time_dim": (["date_key", "full_date", "day", "month", "month_name_it", "quarter", "year", "day_of_week",
                  "day_name_it", "is_weekend", "is_holiday_it", "is_summer"], ["date_key"], [["full_date"]]),
}


def check_not_null_unique(spark, sf_dir):
    loaded = load_driver(spark, sf_dir)
    tables = {"request_fact": loaded.fact, "customer_dim": loaded.customer_dim,
              "supplier_dim": loaded.supplier_dim, "operator_dim": loaded.operator_dim,
              "time_dim": loaded.time_dim}
    parts = [C.not_null_unique(tables[t], t, nn, key, uq) for t, (nn, key, uq) in NOT_NULL.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_row_counts(spark, sf_dir):
    """Q1: inserted rows per table = rows that passed validation (days for the calendar)."""
    loaded = load_driver(spark, sf_dir)
    s = loaded.summary
    exp = (s.select(F.when(F.col("table") == "customers", "customer_dim")
                     .when(F.col("table") == "suppliers", "supplier_dim")
                     .when(F.col("table") == "operators", "operator_dim")
                     .otherwise("request_fact").alias("table"), F.col("n_ok").alias("expected"))
           .unionByName(spark.range(1).select(F.lit("time_dim").alias("table"),
                                              F.lit(loaded.star().calendar_days).cast("bigint").alias("expected"))))
    tables = {"time_dim": loaded.time_dim, "customer_dim": loaded.customer_dim,
              "supplier_dim": loaded.supplier_dim, "operator_dim": loaded.operator_dim,
              "request_fact": loaded.fact}
    return C.row_counts(tables, exp)


def check_report(spark, sf_dir):
    star = load_driver(spark, sf_dir).star()
    # several checks read the keys and the hash
    fact = stored(star.fact.select("customer_key", "supplier_key", "operator_key", "date_key", "hash_record"), "keys")
    return C.star_checks(spark, replace(star, fact=fact))


def warehouse_kpi_summary(spark, sf_dir):
    """K10 over the star built by the load (validated, SCD2 keys, as-of fact)."""
    return kpis.kpi_summary(load_driver(spark, sf_dir).star(), KpiParams.of(*FULL))


def warehouse_revenue_by_province(spark, sf_dir):
    return kpis.kpi_revenue_by_province(load_driver(spark, sf_dir).star(), KpiParams.of(*FULL))


# ------------------------------------------------------------------ oracle side

def _case(expr: str, pairs) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {k!r} THEN {v!r}" if isinstance(k, str)
                                          else f"WHEN {k} THEN {v!r}" for k, v in pairs) + " END"


def time_dim_select(days_sql: str) -> str:
    """Calendar columns over a relation ``days(d DATE)``."""
    month = _case("month(d)", enumerate(MONTH_NAMES_IT, start=1))
    dayname = _case("isodow(d)", enumerate(DAY_NAMES_IT, start=1))
    easter = _case("strftime(d, '%Y-%m-%d')", EASTER_DATES_IT.items())
    fixed = _case("strftime(d, '%m-%d')", FIXED_HOLIDAYS_IT.items())
    hol = f"COALESCE({easter}, {fixed})"
    return f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, {month} AS month_name_it,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       CAST(isodow(d) AS INTEGER) AS day_of_week, {dayname} AS day_name_it,
       CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN {hol} IS NOT NULL THEN 1 ELSE 0 END AS is_holiday_it, {hol} AS holiday_name_it,
       CASE WHEN month(d) IN (7, 8, 9) THEN 1 ELSE 0 END AS is_summer
FROM ({days_sql}) days"""


ORDERS_DAYS = """SELECT CAST(g.d AS DATE) AS d FROM (SELECT MIN(o_orderdate) AS a, MAX(o_orderdate) AS b FROM orders) m,
  generate_series(CAST(CAST(m.a AS DATE) AS TIMESTAMP), CAST(CAST(m.b AS DATE) AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)"""
DRIVER_DAYS = """SELECT CAST(g.d AS DATE) AS d
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(d)"""

TD = f"tdim AS ({time_dim_select(DRIVER_DAYS)})"


def _etl_q(select_sql: str) -> str:
    sql = with_etl("", dims=True)
    return sql.rstrip() + ",\n" + TD + "\n" + select_sql


NN_SQL = {
    "request_fact": ("rfact",) + NOT_NULL["request_fact"],
    "customer_dim": ("cdim",) + NOT_NULL["customer_dim"],
    "supplier_dim": ("sdim",) + NOT_NULL["supplier_dim"],
    "operator_dim": ("odim",) + NOT_NULL["operator_dim"],
    "time_dim": ("tdim",) + NOT_NULL["time_dim"],
}


def _nn_sql() -> str:
    parts = []
    for t, (rel, nn, key, uq) in NN_SQL.items():
        nulls = " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in nn)
        uq_sql = " + ".join(
            f"(SELECT COUNT(*) FROM (SELECT {', '.join(cols)} FROM {rel} GROUP BY ALL HAVING COUNT(*) > 1) u)"
            for cols in uq) or "0"
        parts.append(f"""SELECT '{t}' AS "table", COUNT(*) AS n_rows, CAST({nulls} AS BIGINT) AS null_violations,
  (SELECT COUNT(*) FROM (SELECT {', '.join(key)} FROM {rel} GROUP BY ALL HAVING COUNT(*) > 1) d) AS dup_keys,
  CAST({uq_sql} AS BIGINT) AS dup_unique FROM {rel}""")
    inner = "\nUNION ALL ".join(parts)
    return f"""SELECT *, null_violations = 0 AND dup_keys = 0 AND dup_unique = 0 AS ok FROM ({inner}) t"""


SQL = {
    "time_dim": time_dim_select(ORDERS_DAYS),
    "check_calendar": f"""SELECT COUNT(*) AS n_rows, COUNT(DISTINCT full_date) AS n_dates,
  MIN(full_date) AS first_date, MAX(full_date) AS last_date,
  COALESCE(COUNT(*) = COUNT(DISTINCT full_date) AND date_diff('day', MIN(full_date), MAX(full_date)) + 1 = COUNT(*),
           COUNT(*) = 0) AS ok
FROM ({time_dim_select(ORDERS_DAYS)}) t""",
    "check_fk_orphans": _etl_q("""SELECT fk, orphans, orphans = 0 AS ok FROM (
  SELECT 'customer_key' AS fk, COUNT(*) AS orphans FROM rfact WHERE customer_key IS NOT NULL AND customer_key NOT IN (SELECT customer_key FROM cdim)
  UNION ALL SELECT 'supplier_key', COUNT(*) FROM rfact WHERE supplier_key IS NOT NULL AND supplier_key NOT IN (SELECT supplier_key FROM sdim)
  UNION ALL SELECT 'operator_key', COUNT(*) FROM rfact WHERE operator_key IS NOT NULL AND operator_key NOT IN (SELECT operator_key FROM odim)
  UNION ALL SELECT 'date_key', COUNT(*) FROM rfact WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM tdim)) t"""),
    "check_scd2": _etl_q("""SELECT CAST(COALESCE(SUM(cur), 0) AS BIGINT) AS n_current, COUNT(*) AS n_personas,
  COUNT(*) FILTER (WHERE cur > 1) AS n_multi_current,
  COUNT(*) FILTER (WHERE cur > 1) = 0 AND COALESCE(SUM(cur), 0) = COUNT(*) AS ok
FROM (SELECT fiscal_code_hash, SUM(is_current) AS cur FROM cdim GROUP BY fiscal_code_hash) t"""),
    "check_hash_unique": _etl_q("""SELECT COUNT(*) AS n_rows, COUNT(DISTINCT hash_record) AS n_distinct,
  COUNT(*) = COUNT(DISTINCT hash_record) AS ok FROM rfact"""),
    "check_status_share": base_cte(*FULL) + f"""
, exp(value, target, tolerance) AS (VALUES {', '.join(f"('{v}', CAST({t!r} AS DOUBLE), CAST({SHARE_TOLERANCE!r} AS DOUBLE))" for v, t in SHARE_TARGETS)}),
obs AS (SELECT status AS value, COUNT(*) AS n FROM fact GROUP BY status),
tot AS (SELECT COUNT(*) AS total FROM fact)
SELECT e.value, CAST(COALESCE(o.n, 0) AS BIGINT) AS n,
  CASE WHEN tot.total > 0 THEN CAST(COALESCE(o.n, 0) AS DOUBLE) / tot.total END AS share, e.target, e.tolerance,
  COALESCE(abs(CASE WHEN tot.total > 0 THEN CAST(COALESCE(o.n, 0) AS DOUBLE) / tot.total END - e.target) <= e.tolerance, FALSE) AS ok
FROM exp e LEFT JOIN obs o ON e.value = o.value, tot""",
    "check_kpi_reconcile": base_cte(*FULL) + """
SELECT COUNT(*) AS k1, CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) AS k6,
  CAST(COALESCE(SUM(is_cancelled), 0) AS BIGINT) AS n_cancelled,
  COALESCE(abs(CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) * COUNT(*) - COALESCE(SUM(is_cancelled), 0)) <= 1e-6,
           COUNT(*) = 0) AS ok
FROM base""",
    "check_ratio_range": base_cte(*FULL) + """
, k6 AS (SELECT CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) AS cancel_rate FROM base),
k7 AS (SELECT CAST(SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0) AS retention
       FROM (SELECT fiscal_code_hash, COUNT(*) AS n FROM base GROUP BY fiscal_code_hash) p)
SELECT cancel_rate, retention,
  COALESCE(cancel_rate BETWEEN 0 AND 1, cancel_rate IS NULL) AND COALESCE(retention BETWEEN 0 AND 1, retention IS NULL) AS ok
FROM k6, k7""",
    "check_labels": base_cte(*FULL) + f"""
, d AS (SELECT strftime(full_date, '%Y-%m-%d') AS period_label FROM base
        WHERE full_date BETWEEN DATE '{SHORT[0]}' AND DATE '{SHORT[1]}' GROUP BY 1),
w AS (SELECT strftime(full_date, '%Y-W%W') AS period_label FROM base GROUP BY 1)
SELECT 'daily' AS granularity, COUNT(*) AS n_labels,
  COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(period_label, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$'), FALSE)) AS n_bad,
  COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(period_label, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$'), FALSE)) = 0 AS ok FROM d
UNION ALL
SELECT 'weekly', COUNT(*),
  COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(period_label, '^\\d{{4}}-W\\d{{2}}$'), FALSE)),
  COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(period_label, '^\\d{{4}}-W\\d{{2}}$'), FALSE)) = 0 FROM w""",
    "check_filter_monotonic": base_cte(*FULL) + f"""
SELECT COUNT(*) AS n_all, COUNT(*) FILTER (WHERE province = '{PROVINCE}') AS n_filtered,
  COUNT(*) FILTER (WHERE province = '{PROVINCE}') > 0 AND COUNT(*) FILTER (WHERE province = '{PROVINCE}') < COUNT(*) AS ok
FROM base""",
    "source_profile": with_etl("""
SELECT 'customers' AS source, COUNT(*) AS n_rows, CAST(NULL AS TIMESTAMP) AS min_ts, CAST(NULL AS TIMESTAMP) AS max_ts FROM customers
UNION ALL SELECT 'suppliers', COUNT(*), NULL, NULL FROM suppliers
UNION ALL SELECT 'operators', COUNT(*), NULL, NULL FROM operators
UNION ALL SELECT 'requests', COUNT(*), MIN(request_datetime), MAX(request_datetime) FROM requests"""),
    "check_not_null_unique": _etl_q(_nn_sql()),
    "check_row_counts": _etl_q("""SELECT t.tbl AS "table", t.actual, e.expected, COALESCE(t.actual = e.expected, FALSE) AS ok FROM (
  SELECT 'time_dim' AS tbl, COUNT(*) AS actual FROM tdim
  UNION ALL SELECT 'customer_dim', COUNT(*) FROM cdim
  UNION ALL SELECT 'supplier_dim', COUNT(*) FROM sdim
  UNION ALL SELECT 'operator_dim', COUNT(*) FROM odim
  UNION ALL SELECT 'request_fact', COUNT(*) FROM rfact) t
FULL JOIN (
  SELECT 'time_dim' AS tbl, CAST(2557 AS BIGINT) AS expected
  UNION ALL SELECT 'customer_dim', COUNT(*) FROM c_ok
  UNION ALL SELECT 'supplier_dim', COUNT(*) FROM s_ok
  UNION ALL SELECT 'operator_dim', COUNT(*) FROM o_ok
  UNION ALL SELECT 'request_fact', COUNT(*) FROM r_ok) e ON t.tbl = e.tbl"""),
    "warehouse_kpi_summary": _etl_q("""
, wb AS (
  SELECT f.*, td.full_date, cd.fiscal_code_hash, cd.province, sd.category
  FROM rfact f JOIN tdim td ON f.date_key = td.date_key
  JOIN cdim cd ON f.customer_key = cd.customer_key JOIN sdim sd ON f.supplier_key = sd.supplier_key
  WHERE td.full_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
), pp AS (
  SELECT fiscal_code_hash, COUNT(*) AS n,
         SUM(CASE WHEN is_cancelled = 0 AND is_completed = 1 THEN CAST(price AS DECIMAL(18, 6)) END) AS amount,
         SUM(CASE WHEN is_cancelled = 0 AND is_completed = 1 THEN service_duration_minutes END) AS dur_sum,
         COUNT(CASE WHEN is_cancelled = 0 AND is_completed = 1 THEN service_duration_minutes END) AS dur_n,
         SUM(is_cancelled) AS n_cancelled
  FROM wb GROUP BY fiscal_code_hash
)
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_requests,
       COALESCE(CAST(CAST(SUM(amount) AS VARCHAR) AS DOUBLE), CAST(0 AS DOUBLE)) AS revenue,
       CAST(SUM(dur_sum) AS DOUBLE) / NULLIF(SUM(dur_n), 0) AS mean_duration,
       COUNT(*) AS active_customers,
       CAST(SUM(n_cancelled) AS DOUBLE) / NULLIF(SUM(n), 0) AS cancel_rate,
       CAST(SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0) AS retention,
       DATE '1995-01-01' AS period_start, DATE '2001-12-31' AS period_end,
       CAST(NULL AS VARCHAR) AS province, CAST(NULL AS VARCHAR) AS category
FROM pp"""),
    "warehouse_revenue_by_province": _etl_q("""
, wb AS (
  SELECT f.*, cd.province FROM rfact f JOIN tdim td ON f.date_key = td.date_key
  JOIN cdim cd ON f.customer_key = cd.customer_key JOIN sdim sd ON f.supplier_key = sd.supplier_key
  WHERE td.full_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
)
SELECT province, CAST(CAST(SUM(CAST(price AS DECIMAL(18, 6))) AS VARCHAR) AS DOUBLE) AS revenue_in_province,
       COUNT(*) AS n_requests_in_province
FROM wb WHERE is_cancelled = 0 AND is_completed = 1 GROUP BY province"""),
    "check_report": _etl_q("""
, fk AS (SELECT CAST(SUM(n) AS BIGINT) AS orphans FROM (
  SELECT COUNT(*) AS n FROM rfact WHERE customer_key IS NOT NULL AND customer_key NOT IN (SELECT customer_key FROM cdim)
  UNION ALL SELECT COUNT(*) FROM rfact WHERE supplier_key IS NOT NULL AND supplier_key NOT IN (SELECT supplier_key FROM sdim)
  UNION ALL SELECT COUNT(*) FROM rfact WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM tdim)
  UNION ALL SELECT COUNT(*) FROM rfact WHERE operator_key IS NOT NULL AND operator_key NOT IN (SELECT operator_key FROM odim)) u),
sc AS (SELECT CAST(COALESCE(SUM(cur), 0) AS BIGINT) AS n_current, COUNT(*) AS n_personas,
              COUNT(*) FILTER (WHERE cur > 1) AS n_multi
       FROM (SELECT fiscal_code_hash, SUM(is_current) AS cur FROM cdim GROUP BY fiscal_code_hash) t),
ca AS (SELECT COUNT(*) AS n_rows, COUNT(DISTINCT full_date) AS n_dates,
              date_diff('day', MIN(full_date), MAX(full_date)) + 1 AS span FROM tdim),
hu AS (SELECT COUNT(*) AS n_rows, COUNT(DISTINCT hash_record) AS n_distinct FROM rfact),
chk AS (
  SELECT 'fk_orphans' AS name, orphans = 0 AS ok, printf('orphans=%d', orphans) AS message FROM fk
  UNION ALL SELECT 'scd2', n_multi = 0 AND n_current = n_personas,
         printf('current=%d personas=%d multi_current=%d', n_current, n_personas, n_multi) FROM sc
  UNION ALL SELECT 'calendar', COALESCE(n_rows = n_dates AND span = n_rows, n_rows = 0),
         printf('rows=%d distinct=%d', n_rows, n_dates) FROM ca
  UNION ALL SELECT 'hash_unique', n_rows = n_distinct, printf('rows=%d distinct=%d', n_rows, n_distinct) FROM hu
)
SELECT name, ok, message, (SELECT COUNT(*) FROM chk) AS n_checks,
       (SELECT COUNT(*) FILTER (WHERE ok) FROM chk) AS n_passed FROM chk"""),
}

BUILDERS = {
    "time_dim": time_dim_q,
    "check_calendar": check_calendar,
    "check_fk_orphans": check_fk_orphans,
    "check_scd2": check_scd2,
    "check_hash_unique": check_hash_unique,
    "check_status_share": check_status_share,
    "check_kpi_reconcile": check_kpi_reconcile,
    "check_ratio_range": check_ratio_range,
    "check_labels": check_labels,
    "check_filter_monotonic": check_filter_monotonic,
    "source_profile": source_profile,
    "check_not_null_unique": check_not_null_unique,
    "check_row_counts": check_row_counts,
    "check_report": check_report,
    "warehouse_kpi_summary": warehouse_kpi_summary,
    "warehouse_revenue_by_province": warehouse_revenue_by_province,
}


def entries() -> dict:
    return {name: (b, SQL.get(name)) for name, b in BUILDERS.items()}
