"""The load (entities, validation, dimensions, as-of fact) as SQL text for the
DuckDB oracle. Written independently of the Spark operators: windows over
whole groups and range joins are fine here, the oracle only runs on small
data."""

from __future__ import annotations

from .oracle_star import STATUS_SQL

ENTITY_CTES = f"""
latest AS (
  SELECT o_custkey, o_orderkey AS latest_key FROM (
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) t WHERE rn = 1
),
customers AS (
  SELECT o.o_orderkey AS id, c_name AS last_name, c_mktsegment AS first_name,
         sha256(CAST(o.o_custkey AS VARCHAR)) AS fiscal_code_hash,
         DATE '1950-01-01' + CAST(FLOOR(c_acctbal) AS INTEGER) AS birth_date,
         CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
         n_name AS city, n_name AS province, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code,
         o.o_orderdate AS registration_datetime,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS has_marketing_consent,
         CASE WHEN o.o_orderkey = l.latest_key THEN 'active'
              WHEN o.o_orderstatus = 'P' THEN 'pending' ELSE 'historicized' END AS status
  FROM orders o JOIN latest l ON o.o_custkey = l.o_custkey
  JOIN customer ON o.o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
suppliers AS (
  SELECT s_suppkey AS id, s_name AS name, r_name AS category,
         lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS vat_number, n_name AS city, n_name AS province,
         lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip_code,
         CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
         CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
operators AS (
  SELECT p_partkey AS id, p_name AS last_name, p_brand AS first_name, CAST(NULL AS VARCHAR) AS email,
         DATE '2000-01-01' + p_size AS hire_date, p_type AS activity_type,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS province, 'active' AS status
  FROM part
),
requests AS (
  SELECT (l_orderkey * 100 + l_linenumber) * 1000000
           + row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) AS id, l_orderkey AS customer_id, l_suppkey AS supplier_id,
         l_partkey AS operator_id, o_orderdate AS request_datetime,
         CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS completed_datetime,
         {STATUS_SQL} AS status,
         l_extendedprice AS price,
         CASE WHEN l_linestatus = 'F' THEN CAST(TRUNC(l_quantity) AS INTEGER) END AS service_duration_minutes,
         CASE WHEN l_returnflag = 'R' THEN o_orderpriority END AS notes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

# requests under the source's own line key, which repeats in the tables
LINE_KEY_CTES = ENTITY_CTES.replace("""(l_orderkey * 100 + l_linenumber) * 1000000
           + row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                         l_returnflag, l_linestatus, l_shipdate) AS id""", "l_orderkey * 100 + l_linenumber AS id")

CHECK_CTES = """
c_chk AS (
  SELECT *, CASE
    WHEN COUNT(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_id'
    WHEN NOT COALESCE(regexp_matches(fiscal_code_hash, '^[0-9a-f]{64}$'), FALSE) THEN 'invalid_fiscal_code_hash'
    WHEN NOT COALESCE(status IN ('active', 'historicized'), FALSE) THEN 'status_not_allowed'
    WHEN NOT COALESCE(has_marketing_consent IN (0, 1), FALSE) THEN 'consent_not_0_1'
    WHEN birth_date > registration_datetime THEN 'birth_date_after_registration'
    WHEN SUM(CASE WHEN status = 'active' THEN 1 ELSE 0 END) OVER (PARTITION BY fiscal_code_hash) <> 1
      THEN 'active_rows_per_persona_not_1'
    WHEN id IS NULL THEN 'missing_key'
    WHEN registration_datetime IS NULL THEN 'missing_timestamp'
  END AS reason FROM customers
),
c_ok AS (SELECT * EXCLUDE (reason) FROM c_chk WHERE reason IS NULL),
s_chk AS (
  SELECT *, CASE
    WHEN COUNT(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_id'
    WHEN NOT COALESCE(category IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE'), FALSE) THEN 'category_not_allowed'
    WHEN NOT COALESCE(is_active IN (0, 1), FALSE) THEN 'is_active_not_0_1'
    WHEN id IS NULL THEN 'missing_key'
  END AS reason FROM suppliers
),
s_ok AS (SELECT * EXCLUDE (reason) FROM s_chk WHERE reason IS NULL),
o_chk AS (
  SELECT *, CASE
    WHEN COUNT(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_id'
    WHEN NOT COALESCE(activity_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL', 'STANDARD'), FALSE)
      THEN 'activity_type_not_allowed'
    WHEN NOT COALESCE(status IN ('active', 'terminated'), FALSE) THEN 'status_not_allowed'
    WHEN hire_date IS NULL THEN 'hire_date_missing'
    WHEN id IS NULL THEN 'missing_key'
  END AS reason FROM operators
),
o_ok AS (SELECT * EXCLUDE (reason) FROM o_chk WHERE reason IS NULL),
c_first AS (
  SELECT c.id AS cid, m.min_reg FROM c_ok c
  JOIN (SELECT fiscal_code_hash, MIN(registration_datetime) AS min_reg FROM c_ok GROUP BY fiscal_code_hash) m
    ON c.fiscal_code_hash = m.fiscal_code_hash
),
r_dup AS (SELECT *, COUNT(*) OVER (PARTITION BY id) AS n_id FROM requests),
r_chk AS (
  SELECT r.* EXCLUDE (n_id), CASE
    WHEN n_id > 1 THEN 'duplicate_id'
    WHEN cid IS NULL THEN 'customer_id_not_found'
    WHEN sid IS NULL THEN 'supplier_id_not_found'
    WHEN oid IS NULL THEN 'operator_id_not_found'
    WHEN NOT COALESCE(status IN ('booked', 'confirmed', 'completed', 'invoiced', 'cancelled'), FALSE)
      THEN 'status_not_allowed'
    WHEN NOT COALESCE(price > 0 AND NOT isnan(price), FALSE) THEN 'price_not_positive'
    WHEN status IN ('completed', 'invoiced') AND (completed_datetime IS NULL OR service_duration_minutes IS NULL)
      THEN 'completed_without_datetime_or_duration'
    WHEN status IN ('booked', 'confirmed') AND (completed_datetime IS NOT NULL OR service_duration_minutes IS NOT NULL)
      THEN 'pending_with_datetime_or_duration'
    WHEN status = 'cancelled' AND (completed_datetime IS NOT NULL OR service_duration_minutes IS NOT NULL OR notes IS NULL)
      THEN 'cancelled_incoherent_or_without_notes'
    WHEN completed_datetime IS NOT NULL AND completed_datetime < request_datetime THEN 'completed_before_request'
    WHEN request_datetime > TIMESTAMP '2001-06-30 23:59:59' THEN 'request_after_cutoff'
    WHEN min_reg IS NOT NULL AND request_datetime <= min_reg THEN 'request_not_after_first_registration'
    WHEN id IS NULL THEN 'missing_key'
    WHEN request_datetime IS NULL THEN 'missing_timestamp'
  END AS reason
  FROM r_dup r
  LEFT JOIN c_first ON r.customer_id = c_first.cid
  LEFT JOIN (SELECT DISTINCT id AS sid FROM s_ok) s ON r.supplier_id = s.sid
  LEFT JOIN (SELECT DISTINCT id AS oid FROM o_ok) op ON r.operator_id = op.oid
),
r_ok AS (SELECT * EXCLUDE (reason) FROM r_chk WHERE reason IS NULL),
quarantine AS (
  SELECT 'customers' AS "table", CAST(id AS VARCHAR) AS key, reason FROM c_chk WHERE reason IS NOT NULL
  UNION ALL SELECT 'suppliers', CAST(id AS VARCHAR), reason FROM s_chk WHERE reason IS NOT NULL
  UNION ALL SELECT 'operators', CAST(id AS VARCHAR), reason FROM o_chk WHERE reason IS NOT NULL
  UNION ALL SELECT 'requests', CAST(id AS VARCHAR), reason FROM r_chk WHERE reason IS NOT NULL
),
totals AS (
  SELECT 'customers' AS "table", COUNT(*) AS n_total FROM customers
  UNION ALL SELECT 'suppliers', COUNT(*) FROM suppliers
  UNION ALL SELECT 'operators', COUNT(*) FROM operators
  UNION ALL SELECT 'requests', COUNT(*) FROM requests
)"""

DIM_CTES = """
cdim AS (
  SELECT row_number() OVER (ORDER BY first_id, registration_datetime, id) AS customer_key,
         id AS customer_id, last_name, first_name, fiscal_code_hash, birth_date, email, city, province,
         zip_code, has_marketing_consent, registration_datetime, registration_datetime AS valid_from,
         LEAD(registration_datetime) OVER w AS valid_to,
         CASE WHEN LEAD(1) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
  FROM (SELECT *, MIN(id) OVER (PARTITION BY fiscal_code_hash) AS first_id FROM c_ok) c
  WINDOW w AS (PARTITION BY fiscal_code_hash ORDER BY registration_datetime, id)
),
sdim AS (
  SELECT row_number() OVER (ORDER BY id) AS supplier_key, id AS supplier_id, name, category, vat_number,
         city, province, zip_code, is_active
  FROM s_ok
),
odim AS (
  SELECT row_number() OVER (ORDER BY id) AS operator_key, id AS operator_id, last_name, first_name, email,
         activity_type, city, province, hire_date, status
  FROM o_ok
),
r_key AS (
  SELECT r.*, cd.customer_key
  FROM r_ok r
  LEFT JOIN c_ok c ON r.customer_id = c.id
  LEFT JOIN cdim cd ON cd.fiscal_code_hash = c.fiscal_code_hash
   AND cd.valid_from <= r.request_datetime
   AND (cd.valid_to IS NULL OR r.request_datetime < cd.valid_to)
),
rfact AS (
  SELECT CAST(r.id AS BIGINT) AS request_id, r.customer_key, s.supplier_key, o.operator_key,
         CAST(strftime(r.request_datetime, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(r.price AS DOUBLE) AS price, r.service_duration_minutes,
         CASE WHEN r.status IN ('completed', 'invoiced') THEN 1 ELSE 0 END AS is_completed,
         CASE WHEN r.status = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
         r.status,
         sha256(concat_ws('|', COALESCE(CAST(r.customer_id AS VARCHAR), ''),
                               COALESCE(CAST(r.supplier_id AS VARCHAR), ''),
                               COALESCE(CAST(r.operator_id AS VARCHAR), ''),
                               COALESCE(strftime(r.request_datetime, '%Y-%m-%d %H:%M:%S'), ''),
                               COALESCE(printf('%.2f', r.price), ''))) AS hash_record,
         r.request_datetime, r.completed_datetime, r.notes
  FROM r_key r
  LEFT JOIN sdim s ON r.supplier_id = s.supplier_id
  LEFT JOIN odim o ON r.operator_id = o.operator_id
)"""


def with_etl(select_sql: str, dims: bool = False, entities: str = ENTITY_CTES) -> str:
    ctes = entities + "," + CHECK_CTES + ("," + DIM_CTES if dims else "")
    return f"WITH {ctes}\n{select_sql}"
