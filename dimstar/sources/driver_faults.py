"""A second set of source entities, derived from the driver's tables so that
every validation rule meets rows that break it.

The texts are plain SQL that both engines read; ``{sha}`` is the SHA-256
function. Requests have unique ids (one per order, apart from the duplicates
put in on purpose) and refer to the persona's first customer row, so the
version valid at the request time is usually another one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from .driver import RuleConfig, driver_rules, table

_KEYS = """(SELECT o_custkey AS persona, MIN(o_orderkey) AS first_key, MAX(o_orderkey) AS last_key
   FROM {orders} GROUP BY o_custkey)"""


def _with_faults(columns: str, source: str, key: str, twice: int) -> str:
    """The rows, some of them twice, and one more without an id."""
    body = f"SELECT {{id}} AS id, {columns} FROM {source}"
    lowest = f"{key} = (SELECT MIN({key}) FROM {{smallest}})"
    return (body.replace("{id}", key) + " UNION ALL " + body.replace("{id}", key) + f" WHERE {key} % {twice} = 6 UNION ALL "
            + body.replace("{id}", "CAST(NULL AS BIGINT)") + f" WHERE {lowest}")


CUSTOMERS = _with_faults(
    """c_name AS last_name, c_mktsegment AS first_name,
  CASE WHEN o_orderkey % 97 = 1 THEN 'not a hash' ELSE {sha} END AS fiscal_code_hash,
  CASE WHEN o_orderkey % 83 = 3 THEN DATE '2030-01-01' ELSE DATE '1950-01-01' END AS birth_date,
  CAST(NULL AS STRING) AS email, CAST(NULL AS STRING) AS phone, n_name AS city, n_name AS province, '00100' AS zip_code,
  CASE WHEN o_orderkey % 73 = 5 THEN NULL ELSE o_orderdate END AS registration_datetime,
  CAST(CASE WHEN o_orderkey % 89 = 2 THEN 2 ELSE o_orderkey % 2 END AS INT) AS has_marketing_consent,
  CASE WHEN o_orderkey % 101 = 4 THEN 'unknown' WHEN o_orderkey = last_key OR o_orderkey % 379 = 4 THEN 'active'
       ELSE 'historicized' END AS status""",
    "{orders} JOIN " + _KEYS + " k ON o_custkey = persona JOIN {customer} ON o_custkey = c_custkey "
    "JOIN {nation} ON c_nationkey = n_nationkey", "o_orderkey", 71).replace("{smallest}", "{orders}")

SUPPLIERS = _with_faults(
    """s_name AS name, r_name AS category, '00000000001' AS vat_number, n_name AS city, n_name AS province,
  '00100' AS zip_code, CAST(NULL AS STRING) AS email, CAST(NULL AS STRING) AS phone,
  CASE WHEN s_suppkey % 43 = 3 THEN 7 ELSE 1 END AS is_active""",
    "{supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey",
    "s_suppkey", 37).replace("{smallest}", "{supplier}")

OPERATORS = _with_faults(
    """p_name AS last_name, p_brand AS first_name, CAST(NULL AS STRING) AS email,
  CASE WHEN p_partkey % 41 = 4 THEN NULL ELSE DATE '2000-01-01' END AS hire_date, p_type AS activity_type,
  CAST(NULL AS STRING) AS city, CAST(NULL AS STRING) AS province,
  CASE WHEN p_partkey % 31 = 3 THEN 'retired' ELSE 'active' END AS status""",
    "{part}", "p_partkey", 47).replace("{smallest}", "{part}")

_STATUS = """CASE o_orderkey % 5 WHEN 0 THEN 'booked' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'completed'
    WHEN 3 THEN 'invoiced' ELSE 'cancelled' END"""
_REQUEST = """CASE WHEN o_orderkey % 107 = 5 THEN -1 ELSE first_key END AS customer_id, supplier AS supplier_id,
  part AS operator_id,
  CASE WHEN o_orderkey % 109 = 6 THEN NULL ELSE o_orderdate + INTERVAL 1 HOUR END AS request_datetime,
  CASE WHEN o_orderkey % 5 NOT IN (2, 3) OR o_orderkey % 47 = 8 THEN NULL
       WHEN o_orderkey % 53 = 9 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate + INTERVAL 1 DAY END AS completed_datetime,
  CASE WHEN o_orderkey % 113 = 7 THEN 'lost' ELSE """ + _STATUS + """ END AS status,
  CASE WHEN o_orderkey % 59 = 10 THEN 0D ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 5 IN (2, 3) OR o_orderkey % 61 = 11 THEN 30 END AS service_duration_minutes,
  CASE WHEN o_orderkey % 5 = 4 AND o_orderkey % 67 <> 12 THEN 'cancelled by customer' END AS notes"""
_REQUEST_ROWS = "{orders} JOIN " + _KEYS + """ k ON o_custkey = persona
  JOIN (SELECT l_orderkey, MIN(l_suppkey) AS supplier, MIN(l_partkey) AS part FROM {lineitem} GROUP BY l_orderkey) l
    ON l_orderkey = o_orderkey"""
# some requests come again under another id: same content, same row hash
REQUESTS = _with_faults(_REQUEST, _REQUEST_ROWS, "o_orderkey", 103).replace("{smallest}", "{orders}") + \
    f" UNION ALL SELECT o_orderkey + 1000000000000 AS id, {_REQUEST} FROM {_REQUEST_ROWS} WHERE o_orderkey % 31 = 2"

_SOURCE = {"customers": "{orders} JOIN " + _KEYS + " k ON o_custkey = persona JOIN {customer} ON o_custkey = c_custkey "
                       "JOIN {nation} ON c_nationkey = n_nationkey",
           "suppliers": "{supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey",
           "operators": "{part}", "requests": _REQUEST_ROWS}
ENTITIES = {"customers": CUSTOMERS, "suppliers": SUPPLIERS, "operators": OPERATORS, "requests": REQUESTS}
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _in_one_pass(entity: str, text: str) -> str:
    """The rows of an entity's text with its source read once: the parts of the
    union differ in the id only, so a row is made once and gets an id per part
    that holds it."""
    parts = [p.removeprefix("SELECT ").split(" AS id, ", 1) for p in text.split(" UNION ALL ")]
    body = parts[0][1]
    columns, source = body.rsplit("FROM " + _SOURCE[entity], 1)[0], _SOURCE[entity]
    wheres = [rest.removeprefix(body).removeprefix(" WHERE ") or "true" for _, rest in parts]
    if not all(rest.startswith(body) for _, rest in parts):
        raise ValueError(f"{entity}: the parts differ in more than the id")
    ids = ", ".join(f"IF({w}, array(CAST({i} AS BIGINT)), CAST(array() AS ARRAY<BIGINT>))" for (i, _), w in zip(parts, wheres, strict=True))
    return f"SELECT explode(_ids) AS id, * EXCEPT (_ids) FROM (SELECT concat({ids}) AS _ids, {columns} FROM {source})"


def faulty_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    text = _in_one_pass(entity, ENTITIES[entity]).replace("{sha}", "sha2(CAST(o_custkey AS STRING), 256)")
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _TABLES if f"{{{t}}}" in text})


def oracle_ctes() -> str:
    """The same entities as common table expressions for the oracle."""
    out = []
    for name, text in ENTITIES.items():
        text = text.replace("{sha}", "sha256(CAST(o_custkey AS STRING))").replace("0D", "CAST(0 AS DOUBLE)")
        for t in _TABLES:
            text = text.replace(f"{{{t}}}", t)
        out.append(f"{name} AS ({text})")
    return ",\n".join(out)


def faulty_rules() -> RuleConfig:
    return driver_rules()


# Covers the order dates and the hour after them.
FAULTY_CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
