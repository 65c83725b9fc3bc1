"""Registered queries: name -> (Spark builder, oracle SQL).

Every Spark builder takes ``(spark, sf_dir)``, reads the driver tables and
returns a DataFrame without running an action (except checkpoints that cut
lineage, and frames that are stored because several parts read them). The oracle SQL runs on DuckDB views of the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..model import KpiParams
from ..operators import kpis
from ..session import kept_with
from ..sources.driver import driver_star
from . import oracle_star

Builder = Callable[[SparkSession, str], DataFrame]

FULL = ("1995-01-01", "2001-12-31")
SHORT = ("1996-01-01", "1996-03-31")  # exactly 90 days apart -> daily
PROVINCE = "NATION_3"
CATEGORY = "EUROPE"
EMPTY_PROVINCE = "ZZ"

# name -> (kpi function name, (start, end), province, category)
KPI_CASES: dict[str, tuple[str, tuple[str, str], str | None, str | None]] = {
    "kpi_request_count": ("request_count", FULL, None, None),
    "kpi_request_count_filtered": ("request_count", FULL, PROVINCE, CATEGORY),
    "kpi_request_count_empty": ("request_count", FULL, EMPTY_PROVINCE, None),
    "kpi_revenue": ("revenue", FULL, None, None),
    "kpi_revenue_category": ("revenue", FULL, None, CATEGORY),
    "kpi_revenue_empty": ("revenue", FULL, EMPTY_PROVINCE, None),
    "kpi_mean_duration": ("mean_duration", FULL, None, None),
    "kpi_mean_duration_empty": ("mean_duration", FULL, EMPTY_PROVINCE, None),
    "kpi_active_customers": ("active_customers", FULL, None, None),
    "kpi_active_customers_category": ("active_customers", FULL, None, CATEGORY),
    "kpi_active_customers_empty": ("active_customers", FULL, EMPTY_PROVINCE, None),
    "kpi_revenue_by_province": ("revenue_by_province", FULL, None, None),
    "kpi_revenue_by_province_category": ("revenue_by_province", FULL, None, CATEGORY),
    "kpi_revenue_by_province_empty": ("revenue_by_province", FULL, EMPTY_PROVINCE, None),
    "kpi_cancel_rate": ("cancel_rate", FULL, None, None),
    "kpi_cancel_rate_province": ("cancel_rate", FULL, PROVINCE, None),
    "kpi_cancel_rate_empty": ("cancel_rate", FULL, EMPTY_PROVINCE, None),
    "kpi_retention": ("retention", FULL, None, None),
    "kpi_retention_short": ("retention", SHORT, None, None),
    "kpi_retention_empty": ("retention", FULL, EMPTY_PROVINCE, None),
    "kpi_summary": ("summary", FULL, None, None),
    "kpi_summary_filtered": ("summary", SHORT, PROVINCE, CATEGORY),
    "kpi_summary_empty": ("summary", FULL, EMPTY_PROVINCE, None),
    "trend_daily": ("trend_daily", SHORT, None, None),
    "trend_daily_province": ("trend_daily", SHORT, PROVINCE, None),
    "trend_weekly": ("trend_weekly", FULL, None, None),
    "trend_weekly_category": ("trend_weekly", FULL, None, CATEGORY),
    "trend_weekly_empty": ("trend_weekly", FULL, EMPTY_PROVINCE, None),
    "top_suppliers": ("top_suppliers", FULL, None, None),
    "top_suppliers_province": ("top_suppliers", FULL, PROVINCE, None),
    "top_suppliers_empty": ("top_suppliers", FULL, EMPTY_PROVINCE, None),
    "province_category": ("province_category", FULL, None, None),
    "province_category_short": ("province_category", SHORT, None, CATEGORY),
    "province_category_empty": ("province_category", FULL, EMPTY_PROVINCE, None),
}


def _kpi_builder(fn_name: str, period, province, category, spark: SparkSession, sf_dir: str) -> DataFrame:
    p = KpiParams.of(period[0], period[1], province, category)
    return kpis.KPI_FUNCTIONS[fn_name](driver_star(spark, sf_dir), p)


def _trend_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the granularity is chosen on the driver from the period length."""
    return kpis.trend(driver_star(spark, sf_dir), KpiParams.of(*FULL))


def _queries() -> dict[str, tuple[Builder, str | None]]:
    out: dict[str, tuple[Builder, str | None]] = {}
    for name, (fn, period, prov, cat) in KPI_CASES.items():
        out[name] = (partial(_kpi_builder, fn, period, prov, cat),
                     oracle_star.kpi_sql(fn, period[0], period[1], prov, cat))
    out["trend_auto"] = (_trend_auto, oracle_star.kpi_sql("trend_weekly", *FULL))
    from . import registry_aggregates, registry_checks, registry_etl, registry_faults, registry_io, registry_states
    out.update(registry_etl.entries())
    out.update(registry_states.entries())
    out.update(registry_checks.entries())
    out.update(registry_io.entries())
    out.update(registry_faults.entries())
    out.update(registry_aggregates.entries())
    return out


def queries() -> dict[str, Builder]:
    return {k: kept_with(v[0]) for k, v in _queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _queries().items() if v[1] is not None}
