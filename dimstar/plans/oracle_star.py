"""The driver-table star and the KPI queries as plain SQL text, for an
independent engine (DuckDB) to check the Spark results. These strings are the
test oracle, not an execution path of the library."""

from __future__ import annotations

import datetime as dt

STATUS_SQL = """CASE WHEN l_returnflag = 'R' THEN 'cancelled'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'invoiced'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'completed'
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'confirmed'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'booked' END"""


def time_dim_sql(start: dt.date, end: dt.date) -> str:
    return f"""SELECT CAST(strftime(g.d, '%Y%m%d') AS INTEGER) AS date_key, CAST(g.d AS DATE) AS full_date
  FROM generate_series(TIMESTAMP '{start} 00:00:00', TIMESTAMP '{end} 00:00:00', INTERVAL 1 DAY) AS g(d)"""


STAR_CTES = f"""
li_o AS (
  SELECT *, {STATUS_SQL} AS st
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
fact AS (
  SELECT l_orderkey * 100 + l_linenumber AS request_id,
         o_custkey AS customer_key, l_suppkey AS supplier_key, l_partkey AS operator_key,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
         l_extendedprice AS price,
         CASE WHEN st IN ('completed', 'invoiced') THEN CAST(TRUNC(l_quantity) AS INTEGER) END AS service_duration_minutes,
         CASE WHEN st IN ('completed', 'invoiced') THEN 1 ELSE 0 END AS is_completed,
         CASE WHEN st = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
         st AS status,
         o_orderdate AS request_datetime
  FROM li_o
),
time_dim AS ({time_dim_sql(dt.date(1995, 1, 1), dt.date(2001, 12, 31))}),
customer_dim AS (
  SELECT c_custkey AS customer_key, sha256(CAST(c_custkey AS VARCHAR)) AS fiscal_code_hash, n_name AS province
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
supplier_dim AS (
  SELECT s_suppkey AS supplier_key, s_name AS supplier_name, r_name AS category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def _lit(v) -> str:
    if v is None:
        return "CAST(NULL AS VARCHAR)"
    return "'" + str(v).replace("'", "''") + "'"


def base_cte(start, end, province=None, category=None) -> str:
    where = [f"td.full_date BETWEEN DATE '{start}' AND DATE '{end}'"]
    if province is not None:
        where.append(f"cd.province = {_lit(province)}")
    if category is not None:
        where.append(f"sd.category = {_lit(category)}")
    return f"""WITH {STAR_CTES},
base AS (
  SELECT f.*, td.full_date, cd.fiscal_code_hash, cd.province, sd.supplier_name, sd.category
  FROM fact f
  JOIN time_dim td ON f.date_key = td.date_key
  JOIN customer_dim cd ON f.customer_key = cd.customer_key
  JOIN supplier_dim sd ON f.supplier_key = sd.supplier_key
  WHERE {' AND '.join(where)}
)"""


DONE = "is_cancelled = 0 AND is_completed = 1"
# exact decimal sums; through text, so that the double is the nearest one
AMOUNT = "CAST(price AS DECIMAL(18, 6))"


def exact(total: str) -> str:
    return f"CAST(CAST({total} AS VARCHAR) AS DOUBLE)"




def _env(value_sql: str, reason: str | None, start, end, province, category) -> str:
    r = f"CASE WHEN value IS NULL THEN '{reason}' END" if reason else "NULL"
    return f"""SELECT value, CAST({r} AS VARCHAR) AS reason, DATE '{start}' AS period_start,
       DATE '{end}' AS period_end, {_lit(province)} AS province, {_lit(category)} AS category
FROM ({value_sql}) v"""


def kpi_sql(name: str, start, end, province=None, category=None) -> str:
    b = base_cte(start, end, province, category)
    e = lambda v, r=None: b + "\n" + _env(v, r, start, end, province, category)
    if name == "request_count":
        return e("SELECT COUNT(*) AS value FROM base")
    if name == "revenue":
        return e(f"SELECT COALESCE({exact(f'SUM({AMOUNT})')}, CAST(0 AS DOUBLE)) AS value FROM base WHERE {DONE}")
    if name == "mean_duration":
        return e(f"SELECT CAST(AVG(service_duration_minutes) AS DOUBLE) AS value FROM base WHERE {DONE}",
                 "no_completed_requests")
    if name == "active_customers":
        return e("SELECT COUNT(DISTINCT fiscal_code_hash) AS value FROM base")
    if name == "cancel_rate":
        return e("SELECT CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) AS value FROM base",
                 "no_requests_in_denominator")
    if name == "retention":
        return e("""SELECT CAST(SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0) AS value
FROM (SELECT fiscal_code_hash, COUNT(*) AS n FROM base GROUP BY fiscal_code_hash) pp""",
                 "no_requests_in_denominator")
    if name == "revenue_by_province":
        return b + f"""
SELECT province, {exact(f'SUM({AMOUNT})')} AS revenue_in_province,
       COUNT(*) AS n_requests_in_province
FROM base WHERE {DONE}
GROUP BY province ORDER BY revenue_in_province DESC, province NULLS FIRST"""
    if name == "summary":
        return b + f"""
, pp AS (
  SELECT fiscal_code_hash, COUNT(*) AS n,
         SUM(CASE WHEN {DONE} THEN {AMOUNT} END) AS amount,
         SUM(CASE WHEN {DONE} THEN service_duration_minutes END) AS dur_sum,
         COUNT(CASE WHEN {DONE} THEN service_duration_minutes END) AS dur_n,
         SUM(is_cancelled) AS n_cancelled
  FROM base GROUP BY fiscal_code_hash
)
SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_requests,
       COALESCE({exact('SUM(amount)')}, CAST(0 AS DOUBLE)) AS revenue,
       CAST(SUM(dur_sum) AS DOUBLE) / NULLIF(SUM(dur_n), 0) AS mean_duration,
       COUNT(*) AS active_customers,
       CAST(SUM(n_cancelled) AS DOUBLE) / NULLIF(SUM(n), 0) AS cancel_rate,
       CAST(SUM(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(COUNT(*), 0) AS retention,
       DATE '{start}' AS period_start, DATE '{end}' AS period_end,
       {_lit(province)} AS province, {_lit(category)} AS category
FROM pp"""
    if name == "trend_daily":
        return b + """
SELECT strftime(full_date, '%Y-%m-%d') AS period_label, COUNT(*) AS n_requests
FROM base GROUP BY period_label ORDER BY period_label"""
    if name == "trend_weekly":
        return b + """
SELECT strftime(full_date, '%Y-W%W') AS period_label, COUNT(*) AS n_requests
FROM base GROUP BY period_label ORDER BY period_label"""
    if name == "top_suppliers":
        return b + f"""
SELECT supplier_name, category, revenue_eur, n_requests FROM (
  SELECT supplier_key, supplier_name, category, {exact(f'SUM({AMOUNT})')} AS revenue_eur,
         COUNT(*) AS n_requests
  FROM base WHERE {DONE}
  GROUP BY supplier_key, supplier_name, category
  ORDER BY revenue_eur DESC, supplier_key LIMIT 5) t"""
    if name == "province_category":
        return b + """
SELECT province, category, COUNT(*) AS n_requests
FROM base GROUP BY province, category ORDER BY province, category"""
    raise KeyError(name)
