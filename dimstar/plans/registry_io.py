"""Registered round trips through CSV and through the Parquet warehouse, and
the KPI queries run as Spark SQL text with named parameters."""

from __future__ import annotations

from ..model import KpiParams
from ..operators import kpis
from ..session import scratch_path
from ..sources import csv as CSV
from ..sources import driver
from .load import load_driver, read_warehouse, write_warehouse
from .oracle_etl import with_etl
from .oracle_star import base_cte, kpi_sql
from .registry import CATEGORY, FULL
from .registry_checks import SQL as CHECK_SQL
from .sql_api import MEASURES, run_sql


def _round_trip(entity: str, build):
    """S13 + S14 then S1-S5: write the entity as CSV, read it back typed."""
    def run(spark, sf_dir):
        path = scratch_path(spark, f"csv-{entity}")
        CSV.write_entity(build(spark, sf_dir), path)
        return CSV.read_entity(spark, path, entity)
    return run


def rebuild_idempotent(spark, sf_dir):
    """The same load written twice into one warehouse folder (each
    write is a full rebuild into a new version, then the pointer switch),
    then K10 read back from Parquet; equals K10 of one load."""
    path = scratch_path(spark, "warehouse")
    loaded = load_driver(spark, sf_dir)
    for last in (False, True):
        write_warehouse(loaded, path, release=last)
    star = read_warehouse(spark, path, driver.DRIVER_CALENDAR)
    return kpis.kpi_summary(star, KpiParams.of(*FULL))


def _kpi_sql(name: str, p: KpiParams):
    """K8: a KPI as SQL text with named parameters."""
    return lambda spark, sf_dir: run_sql(spark, driver.driver_star(spark, sf_dir), name, p)


# the two first ones have names and parameters of their own
_SQL_CASES = {"kpi_cancel_rate_sql": ("cancel_rate", None), "kpi_revenue_by_province_sql": ("revenue_by_province", CATEGORY)}
_SQL_CASES |= {f"kpi_{m}_sql" if not m.startswith(("top", "trend", "province_c")) else f"{m}_sql": (m, None)
               for m in MEASURES if m not in ("cancel_rate", "revenue_by_province")}


SQL = {
    "csv_round_trip_customers": with_etl("SELECT * FROM customers"),
    "csv_round_trip_requests": with_etl("SELECT * FROM requests"),
    "csv_round_trip_suppliers": with_etl("SELECT * FROM suppliers"),
    "csv_round_trip_operators": with_etl("SELECT * FROM operators"),
    "rebuild_idempotent": CHECK_SQL["warehouse_kpi_summary"],
    "kpi_cancel_rate_sql": base_cte(*FULL) + """
SELECT CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) AS value FROM base""",
    "kpi_revenue_by_province_sql": base_cte(*FULL, None, CATEGORY) + """
SELECT province, CAST(CAST(SUM(CAST(price AS DECIMAL(18, 6))) AS VARCHAR) AS DOUBLE) AS revenue_in_province,
       COUNT(*) AS n_requests_in_province
FROM base WHERE is_cancelled = 0 AND is_completed = 1 GROUP BY province""",
}

BUILDERS = {
    "csv_round_trip_customers": _round_trip("customers", driver.customers_entity),
    "csv_round_trip_requests": _round_trip("requests", driver.requests_entity),
    "csv_round_trip_suppliers": _round_trip("suppliers", driver.suppliers_entity),
    "csv_round_trip_operators": _round_trip("operators", driver.operators_entity),
    "rebuild_idempotent": rebuild_idempotent,
    **{name: _kpi_sql(m, KpiParams.of(*FULL, category=category)) for name, (m, category) in _SQL_CASES.items()},
}


def _plain(name: str) -> str:
    """The KPI's oracle without the envelope's columns."""
    text = kpi_sql(name, *FULL)
    return f"SELECT value FROM ({text}) e" if "AS period_start" in text else text


for _name, (_m, _) in _SQL_CASES.items():
    SQL.setdefault(_name, _plain(_m))


def entries() -> dict:
    return {name: (b, SQL.get(name)) for name, b in BUILDERS.items()}
