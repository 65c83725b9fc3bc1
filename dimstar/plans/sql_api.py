"""KPI queries as Spark SQL text with named parameters (K8).

One builder makes every text from the same parts as K0: the period restricts
the fact by its own columns (so it reaches the scan and prunes month folders
of a written warehouse), and a dimension is joined only if the measure reads
it, the argument pack filters on it, or the keys were never verified. Values
are always bound by name, never put into the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..model import KpiParams, Star
from ..operators.kpis import MONEY

_FINISHED = "is_completed = 1 AND is_cancelled = 0"
_MONEY_SUM = f"CAST(SUM(CAST(price AS {MONEY.upper()})) AS DOUBLE)"


@dataclass(frozen=True)
class Measure:
    """What a KPI selects over the restricted rows, and what it needs for it."""
    select: str
    where: str = ""
    tail: str = ""
    persona: bool = False
    province: bool = False
    supplier: bool = False


MEASURES = {
    "request_count": Measure("COUNT(*) AS value"),
    "revenue": Measure(f"COALESCE({_MONEY_SUM}, 0D) AS value", _FINISHED),
    "mean_duration": Measure("AVG(service_duration_minutes) AS value", _FINISHED),
    "active_customers": Measure("COUNT(DISTINCT persona) AS value", persona=True),
    "cancel_rate": Measure("CAST(SUM(is_cancelled) AS DOUBLE) / NULLIF(COUNT(*), 0) AS value"),
    "revenue_by_province": Measure(
        f"province, {_MONEY_SUM} AS revenue_in_province, COUNT(*) AS n_requests_in_province", _FINISHED,
        "GROUP BY province ORDER BY revenue_in_province DESC, province", province=True),
    "top_suppliers": Measure(
        f"supplier_name, category, {_MONEY_SUM} AS revenue_eur, COUNT(*) AS n_requests", _FINISHED,
        "GROUP BY supplier_key, supplier_name, category ORDER BY revenue_eur DESC, supplier_key LIMIT 5", supplier=True),
    "province_category": Measure(
        "province, category, COUNT(*) AS n_requests", "", "GROUP BY province, category ORDER BY province, category",
        province=True, supplier=True),
    "trend_daily": Measure("date_format(full_date, 'yyyy-MM-dd') AS period_label, COUNT(*) AS n_requests", "",
                           "GROUP BY full_date ORDER BY period_label"),
}


def kpi_text(name: str, star: Star, p: KpiParams) -> tuple[str, dict]:
    """SQL text of a measure over ``{requests}``, ``{days}``, ``{customers}``
    and ``{suppliers}``, and its arguments."""
    m = MEASURES[name]
    args: dict = {"first_day": p.period_start, "last_day": p.period_end}
    # the period on each column of the fact that follows the day
    bounds = {"date_key": lambda d: d.year * 10000 + d.month * 100 + d.day, "date_month": lambda d: d.year * 100 + d.month}
    own = ["full_date BETWEEN :first_day AND :last_day"]
    for column, key in bounds.items():
        if column in star.fact.columns:
            args |= {f"{column}_low": key(p.period_start), f"{column}_high": key(p.period_end)}
            own.append(f"{column} BETWEEN :{column}_low AND :{column}_high")
    joins = ["JOIN (SELECT date_key, full_date FROM {days}) USING (date_key)"]
    if m.persona or m.province or p.province is not None or not star.fk_checked:
        joins.append("JOIN (SELECT customer_key, fiscal_code_hash AS persona, province FROM {customers}) "
                     "USING (customer_key)")
    if m.supplier or p.category is not None or not star.fk_checked:
        joins.append("JOIN (SELECT supplier_key, name AS supplier_name, category FROM {suppliers}) USING (supplier_key)")
    for column, value in (("province", p.province), ("category", p.category)):
        if value is not None:
            own.append(f"{column} = :{column}")
            args[column] = value
    where = " AND ".join(own + [m.where] * bool(m.where))
    return f"SELECT {m.select} FROM {{requests}} {' '.join(joins)} WHERE {where} {m.tail}", args


def run_sql(spark: SparkSession, star: Star, name: str, p: KpiParams) -> DataFrame:
    """Run the text of KPI ``name`` over the star with the pack's values bound by name."""
    text, args = kpi_text(name, star, p)
    return spark.sql(text, args, requests=star.fact, days=star.time_dim, customers=star.customer_dim,
                     suppliers=star.supplier_dim)
