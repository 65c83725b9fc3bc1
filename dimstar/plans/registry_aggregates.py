"""Registered KPI queries answered from the stored aggregates, for periods
with whole and broken months, with and without filters."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..model import KpiParams
from ..operators import aggregates as A
from ..session import scratch_path
from ..sources import driver
from .load import read_aggregates, write_aggregates
from .oracle_star import kpi_sql

FULL = ("1995-01-01", "2001-12-31")
BROKEN = ("1996-01-17", "1998-11-05")

CASES = {
    "agg_summary": ("summary", FULL, None, None),
    "agg_summary_broken_months": ("summary", BROKEN, None, "EUROPE"),
    "agg_summary_filtered": ("summary", BROKEN, "NATION_3", "ASIA"),
    "agg_active_customers": ("active_customers", BROKEN, "NATION_7", None),
    "agg_revenue_by_province": ("revenue_by_province", BROKEN, None, None),
    "agg_trend_weekly": ("trend_weekly", BROKEN, None, "AFRICA"),
    "agg_top_suppliers": ("top_suppliers", FULL, None, None),
}


def _stored(spark: SparkSession, sf_dir: str) -> A.Aggregates:
    """Written next to the supplier dimension, as in a warehouse version, and read back."""
    base = scratch_path(spark, "aggregates")
    star = driver.driver_star(spark, sf_dir)
    star.supplier_dim.write.parquet(f"{base}/supplier_dim")
    write_aggregates(star, base, driver.DRIVER_CALENDAR)
    return read_aggregates(spark, base)


def _run(name: str, period, province, category, spark: SparkSession, sf_dir: str) -> DataFrame:
    p = KpiParams.of(*period, province, category)
    return A.answer(driver.driver_star(spark, sf_dir), _stored(spark, sf_dir), p, name)


def entries() -> dict:
    return {name: (partial(_run, *case), kpi_sql(case[0], *case[1], *case[2:])) for name, case in CASES.items()}
