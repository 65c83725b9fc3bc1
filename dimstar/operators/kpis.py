"""KPI and chart queries over the star.

Every query starts from :func:`filtered_star` (K0): the fact joined to the
calendar, customer and supplier dimensions, restricted to the period and the
optional province / category. Parameters are Python values folded into
Column predicates on the driver, so an unused filter never reaches the plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_key as date_key_expr
from ..functions.calendar import week_label
from ..functions.constants import WEEKLY_THRESHOLD_DAYS
from ..model import KpiParams, Star

# time_dim is generated from its two dates, so its row count is known before
# the query runs; broadcast it only under this bound (about 270 years).
MAX_BROADCAST_CALENDAR_DAYS = 100_000

REASON_NO_COMPLETED = "no_completed_requests"
REASON_NO_DENOMINATOR = "no_requests_in_denominator"


def _ts_literal(d: dt.date) -> Column:
    return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")


def period_predicate(fact: DataFrame, p: KpiParams) -> Column | None:
    """Period restriction written on the fact's own columns so that it reaches
    the scan (PushedFilters / PartitionFilters), not only the calendar."""
    preds = []
    if "request_datetime" in fact.columns:
        preds.append(F.col("request_datetime") >= _ts_literal(p.period_start))
        preds.append(F.col("request_datetime") < _ts_literal(p.period_end + dt.timedelta(days=1)))
    if "date_key" in fact.columns:
        lo = p.period_start.year * 10000 + p.period_start.month * 100 + p.period_start.day
        hi = p.period_end.year * 10000 + p.period_end.month * 100 + p.period_end.day
        preds.append(F.col("date_key").between(lo, hi))
    if "date_month" in fact.columns:
        preds.append(F.col("date_month").between(
            p.period_start.year * 100 + p.period_start.month,
            p.period_end.year * 100 + p.period_end.month))
    if not preds:
        return None
    out = preds[0]
    for x in preds[1:]:
        out = out & x
    return out


def filtered_star(star: Star, p: KpiParams, customer_cols: tuple[str, ...] = ("fiscal_code_hash", "province"),
                  supplier_cols: tuple[str, ...] = ("supplier_name", "category")) -> DataFrame:
    """K0: fact ⋈ time ⋈ customer ⋈ supplier, period inclusive, optional filters.

    ``customer_cols`` / ``supplier_cols`` name the dimension columns the
    caller reads. On a star whose foreign keys were verified at load time
    (``fk_checked``) a dimension join that neither filters nor adds a needed
    column changes nothing and is left out, which saves a fact-sized shuffle
    when the dimension is too large to broadcast."""
    need_customers = bool(customer_cols) or p.province is not None or not star.fk_checked
    cd = None
    if need_customers:
        cd = star.customer_dim.select("customer_key", "fiscal_code_hash", "province")
        if p.province is not None:
            cd = cd.where(F.col("province") == F.lit(p.province))
    fact = star.fact
    if cd is not None and star.fact_with_customers is not None:
        # the customer join happens on the fact's smaller side, before the fact join
        fact, cd = star.fact_with_customers(cd), None
    pred = period_predicate(fact, p)
    if pred is not None:
        fact = fact.where(pred)
    td = star.time_dim.where(
        F.col("full_date").between(F.lit(p.period_start), F.lit(p.period_end))
    ).select("date_key", "full_date")
    if star.calendar_days is not None and star.calendar_days <= MAX_BROADCAST_CALENDAR_DAYS:
        td = F.broadcast(td)
    out = fact.join(td, "date_key")
    # customer / supplier sides are not hinted: their size grows with the data,
    # so the planner decides from statistics and AQE from runtime sizes.
    if cd is not None:
        out = out.join(cd, "customer_key")
    if supplier_cols or p.category is not None or not star.fk_checked:
        sd = star.supplier_dim.select("supplier_key", F.col("name").alias("supplier_name"), "category")
        if p.category is not None:
            sd = sd.where(F.col("category") == F.lit(p.category))
        out = out.join(sd, "supplier_key")
    return out


def _done(df: DataFrame) -> DataFrame:
    return df.where((F.col("is_cancelled") == 0) & (F.col("is_completed") == 1))


# Prices are doubles; as decimals with six places they add up exactly, in any
# order. 22 digits before the point are more than a double has.
MONEY = "decimal(28,6)"


def money_sum(c: Column | str) -> Column:
    """Sum of an amount as a wide decimal: no float order effects across
    partitions, and no rounding of the amounts to cents. Returned as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast(MONEY)).cast("double")


def envelope(agg: DataFrame, p: KpiParams, reason: str | None) -> DataFrame:
    """K9: one row ``value, reason, period_start, period_end, province, category``;
    ``reason`` is set only when ``value`` is NULL."""
    r = F.when(F.col("value").isNull(), F.lit(reason)) if reason else F.lit(None)
    return agg.select(
        "value",
        r.cast("string").alias("reason"),
        F.lit(p.period_start).alias("period_start"),
        F.lit(p.period_end).alias("period_end"),
        F.lit(p.province).cast("string").alias("province"),
        F.lit(p.category).cast("string").alias("category"),
    )


def kpi_request_count(star: Star, p: KpiParams) -> DataFrame:
    """K1: number of requests (0 on an empty set)."""
    return envelope(filtered_star(star, p, (), ()).agg(F.count(F.lit(1)).alias("value")), p, None)


def kpi_revenue(star: Star, p: KpiParams) -> DataFrame:
    """K2: revenue of completed, not cancelled requests (0 on an empty set)."""
    agg = _done(filtered_star(star, p, (), ())).agg(F.coalesce(money_sum("price"), F.lit(0.0)).alias("value"))
    return envelope(agg, p, None)


def kpi_mean_duration(star: Star, p: KpiParams) -> DataFrame:
    """K3: mean service duration of completed requests; NULL + reason if none."""
    agg = _done(filtered_star(star, p, (), ())).agg(
        F.avg("service_duration_minutes").cast("double").alias("value"))
    return envelope(agg, p, REASON_NO_COMPLETED)


def kpi_active_customers(star: Star, p: KpiParams) -> DataFrame:
    """K4: distinct personas (not versions) with a request in the period."""
    agg = filtered_star(star, p, ("fiscal_code_hash",), ()).agg(
        F.count_distinct("fiscal_code_hash").alias("value"))
    return envelope(agg, p, None)


def kpi_cancel_rate(star: Star, p: KpiParams) -> DataFrame:
    """K6: cancelled / all; NULL + reason on an empty set."""
    agg = filtered_star(star, p, (), ()).agg(
        (F.sum("is_cancelled").cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("value"))
    return envelope(agg, p, REASON_NO_DENOMINATOR)


def kpi_retention(star: Star, p: KpiParams) -> DataFrame:
    """K7: share of personas with at least two requests in the period."""
    per_persona = (filtered_star(star, p, ("fiscal_code_hash",), ())
                   .groupBy("fiscal_code_hash").agg(F.count(F.lit(1)).alias("n")))
    agg = per_persona.agg(
        (F.sum(F.when(F.col("n") >= 2, 1).otherwise(0)).cast("double")
         / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("value"))
    return envelope(agg, p, REASON_NO_DENOMINATOR)


def kpi_revenue_by_province(star: Star, p: KpiParams) -> DataFrame:
    """K5: revenue and count of completed requests per province, revenue desc."""
    return (_done(filtered_star(star, p, ("province",), ()))
            .groupBy("province")
            .agg(money_sum("price").alias("revenue_in_province"),
                 F.count(F.lit(1)).alias("n_requests_in_province"))
            .orderBy(F.col("revenue_in_province").desc(), F.col("province").asc_nulls_first()))


def kpi_summary(star: Star, p: KpiParams) -> DataFrame:
    """The six big numbers in one pass over K0.

    One aggregation per persona (partial on the map side, so a persona with
    very many requests is combined before the shuffle), then one tiny final
    aggregation.
    """
    done = (F.col("is_cancelled") == 0) & (F.col("is_completed") == 1)
    per_persona = filtered_star(star, p, ("fiscal_code_hash",), ()).groupBy("fiscal_code_hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(done, F.col("price").cast(MONEY))).alias("amount"),
        F.sum(F.when(done, F.col("service_duration_minutes")).cast("bigint")).alias("dur_sum"),
        F.count(F.when(done, F.col("service_duration_minutes"))).alias("dur_n"),
        F.sum("is_cancelled").cast("bigint").alias("n_cancelled"),
    )
    n_all = F.sum("n")
    return per_persona.agg(
        F.coalesce(n_all, F.lit(0)).cast("bigint").alias("n_requests"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("revenue"),
        (F.sum("dur_sum").cast("double") / F.nullif(F.sum("dur_n"), F.lit(0))).alias("mean_duration"),
        F.count(F.lit(1)).alias("active_customers"),
        (F.sum("n_cancelled").cast("double") / F.nullif(n_all, F.lit(0))).alias("cancel_rate"),
        (F.sum(F.when(F.col("n") >= 2, 1).otherwise(0)).cast("double")
         / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("retention"),
    ).select(
        "*",
        F.lit(p.period_start).alias("period_start"),
        F.lit(p.period_end).alias("period_end"),
        F.lit(p.province).cast("string").alias("province"),
        F.lit(p.category).cast("string").alias("category"),
    )


def trend_daily(star: Star, p: KpiParams) -> DataFrame:
    """Requests per day; days without requests are absent."""
    return (filtered_star(star, p, (), ())
            .groupBy(F.date_format("full_date", "yyyy-MM-dd").alias("period_label"))
            .agg(F.count(F.lit(1)).alias("n_requests"))
            .orderBy("period_label"))


def trend_weekly(star: Star, p: KpiParams) -> DataFrame:
    """Requests per ``%Y-W%W`` week."""
    return (filtered_star(star, p, (), ())
            .groupBy(week_label("full_date").alias("period_label"))
            .agg(F.count(F.lit(1)).alias("n_requests"))
            .orderBy("period_label"))


def trend_granularity(p: KpiParams, threshold_days: int = WEEKLY_THRESHOLD_DAYS) -> str:
    """G1: more than ``threshold_days`` between the two dates -> weekly."""
    return "weekly" if p.days > threshold_days else "daily"


def trend(star: Star, p: KpiParams) -> DataFrame:
    return trend_weekly(star, p) if trend_granularity(p) == "weekly" else trend_daily(star, p)


def top_suppliers(star: Star, p: KpiParams, k: int = 5) -> DataFrame:
    """Top-k suppliers by revenue of completed requests. Grouped by key so
    equal names stay apart; key breaks revenue ties."""
    grouped = (_done(filtered_star(star, p, (), ("supplier_name", "category")))
               .groupBy("supplier_key", "supplier_name", "category")
               .agg(money_sum("price").alias("revenue_eur"), F.count(F.lit(1)).alias("n_requests")))
    return (grouped.orderBy(F.col("revenue_eur").desc(), F.col("supplier_key").asc())
            .limit(k)
            .select("supplier_name", "category", "revenue_eur", "n_requests"))


def province_category(star: Star, p: KpiParams) -> DataFrame:
    """Requests per province x category; empty cells absent."""
    return (filtered_star(star, p, ("province",), ("category",))
            .groupBy("province", "category")
            .agg(F.count(F.lit(1)).alias("n_requests"))
            .orderBy("province", "category"))


def kpi_named(star: Star, p: KpiParams, name: str) -> DataFrame:
    """K8: run a query by name with one parameter pack."""
    return KPI_FUNCTIONS[name](star, p)


KPI_FUNCTIONS = {
    "request_count": kpi_request_count,
    "revenue": kpi_revenue,
    "mean_duration": kpi_mean_duration,
    "active_customers": kpi_active_customers,
    "revenue_by_province": kpi_revenue_by_province,
    "cancel_rate": kpi_cancel_rate,
    "retention": kpi_retention,
    "summary": kpi_summary,
    "trend": trend,
    "trend_daily": trend_daily,
    "trend_weekly": trend_weekly,
    "top_suppliers": top_suppliers,
    "province_category": province_category,
}

__all__ = [
    "filtered_star", "period_predicate", "money_sum", "envelope", "date_key_expr",
    *[f.__name__ for f in KPI_FUNCTIONS.values()], "trend_granularity", "kpi_named",
]
