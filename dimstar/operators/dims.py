"""Dimension builders (D1-D14): SCD2 customer versions, SCD1 supplier and
operator dimensions, the calendar, and dense surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.constants import CALENDAR_END, CALENDAR_START
from ..model import CUSTOMER_DIM_COLUMNS, OPERATOR_DIM_COLUMNS, SUPPLIER_DIM_COLUMNS, TIME_DIM_SCHEMA
from .keys import dense_keys, number_segments
from .segmented import lead_in_group, segment


def calendar_days(start: dt.date, end: dt.date) -> int:
    return max((end - start).days + 1, 0)


def build_time_dim(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END,
                   variable_holidays: dict[str, str] | None = None) -> DataFrame:
    """One row per day, both ends included.

    The day list is generated by Spark (``sequence`` + ``explode``), never on
    the driver; the row count is ``calendar_days(start, end)``.
    """
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return time_dim_from_bounds(bounds, variable_holidays)


def build_time_dim_covering(df: DataFrame, ts_col: str,
                            variable_holidays: dict[str, str] | None = None) -> DataFrame:
    """D6 over the span of the data: first to last day of ``ts_col``. The
    bounds are one aggregate row, so nothing passes through the driver."""
    bounds = df.agg(F.to_date(F.min(ts_col)).alias("start"), F.to_date(F.max(ts_col)).alias("end"))
    return time_dim_from_bounds(bounds, variable_holidays)


def time_dim_from_bounds(bounds: DataFrame, variable_holidays: dict[str, str] | None = None) -> DataFrame:
    """D6-D12 from a one-row frame ``start, end`` (dates)."""
    days = bounds.where(F.col("start").isNotNull() & (F.col("start") <= F.col("end"))).select(
        F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    hol = cal.holiday_name_it(d, variable_holidays)
    out = days.select(
        cal.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        cal.month_name_it(d).alias("month_name_it"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        cal.day_of_week(d).alias("day_of_week"),
        cal.day_name_it(d).alias("day_name_it"),
        F.when(F.weekday(d) >= 5, 1).otherwise(0).alias("is_weekend"),
        F.when(hol.isNotNull(), 1).otherwise(0).alias("is_holiday_it"),
        hol.alias("holiday_name_it"),
        F.when(F.month(d).isin(7, 8, 9), 1).otherwise(0).alias("is_summer"),
    )
    return out.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in TIME_DIM_SCHEMA.fields])


def build_supplier_dim(suppliers_ok: DataFrame, with_keys: bool = True) -> DataFrame:
    """SCD1 projection; ``supplier_key`` dense in id order."""
    out = suppliers_ok.select(
        F.col("id").alias("supplier_id"), "name", "category", "vat_number", "city", "province",
        "zip_code", "is_active")
    if not with_keys:
        return out
    return dense_keys(out, ["supplier_id"], "supplier_key").select(*SUPPLIER_DIM_COLUMNS)


def build_operator_dim(operators_ok: DataFrame, with_keys: bool = True) -> DataFrame:
    """SCD1 projection; ``operator_key`` dense in id order."""
    out = operators_ok.select(
        F.col("id").alias("operator_id"), "last_name", "first_name", "email", "activity_type",
        "city", "province", F.col("hire_date").cast("date").alias("hire_date"), "status")
    if not with_keys:
        return out
    return dense_keys(out, ["operator_id"], "operator_key").select(*OPERATOR_DIM_COLUMNS)


def scd2_versions(df: DataFrame, persona: str = "fiscal_code_hash", ts: str = "registration_datetime",
                  tiebreak: str = "id") -> DataFrame:
    """One version per source row, ordered per persona by (ts, tiebreak):
    ``valid_from`` = own ts, ``valid_to`` = next ts (NULL if last),
    ``is_current`` = 1 only for the last row (from the existence of a next
    row, not from a NULL next ts). Balanced for personas with many rows."""
    withnext = lead_in_group(df, [persona], [ts, tiebreak], ts, "valid_to", "_has_next")
    return (withnext
            .withColumn("valid_from", F.col(ts))
            .withColumn("is_current", F.when(F.col("_has_next"), 0).otherwise(1))
            .drop("_has_next"))


def build_customer_dim_scd2(customers_ok: DataFrame, with_keys: bool = True) -> DataFrame:
    """D1 + D13 + D14: customer versions with dense ``customer_key`` in the order
    (first id of the persona, registration, id).

    Ordering by the persona's first id keeps each persona contiguous, so one
    range partitioning (and one stored frame) serves both the SCD2 ``lead``
    inside a persona and the global key numbering."""
    first_id = customers_ok.groupBy(F.col("fiscal_code_hash").alias("_p")).agg(F.min("id").alias("_first_id"))
    # null-safe, so that both sides get an exchange of their own and AQE can split a hot persona
    x = customers_ok.join(first_id, F.col("fiscal_code_hash").eqNullSafe(F.col("_p"))).drop("_p")
    order = ["registration_datetime", "id"]
    seg = segment(x, ["_first_id"], order, with_position=with_keys)
    v = lead_in_group(seg, ["_first_id"], order, "registration_datetime", "valid_to", "_has_next",
                      segmented=True)
    v = (v.withColumn("valid_from", F.col("registration_datetime"))
          .withColumn("is_current", F.when(F.col("_has_next"), 0).otherwise(1))
          .withColumnRenamed("id", "customer_id"))
    if with_keys:
        v = number_segments(v, "customer_key")
    else:
        v = v.withColumn("customer_key", F.lit(None).cast("bigint"))
    return v.select(*CUSTOMER_DIM_COLUMNS)


def scd2_coherence(customer_versions: DataFrame) -> DataFrame:
    """Rows where (is_current = 1) differs from (status = 'active'); kept, only reported."""
    return customer_versions.where(
        (F.col("is_current") == 1) != F.coalesce(F.col("status") == "active", F.lit(False)))


def scd2_stats(customer_dim: DataFrame, persona: str = "fiscal_code_hash") -> DataFrame:
    """D3: personas, personas with more than one version, rows, current rows."""
    per = customer_dim.groupBy(persona).agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_current").alias("cur"))
    return per.agg(
        F.count(F.lit(1)).alias("n_personas"),
        F.count(F.when(F.col("n") > 1, 1)).alias("n_personas_multi"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("cur"), F.lit(0)).cast("bigint").alias("n_current"),
    )
