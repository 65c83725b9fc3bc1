"""Typed containers of the star schema and the what-if parameters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable  # noqa: F401  (used in a string annotation)
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Star:
    """Fact and the dimensions the KPI queries join (operator_dim is never
    joined by a KPI, it is carried for the checks)."""

    fact: DataFrame
    time_dim: DataFrame
    customer_dim: DataFrame
    supplier_dim: DataFrame
    operator_dim: DataFrame | None = None
    calendar_days: int | None = None  # row bound of time_dim, known from its parameters
    # True when every foreign key of the fact is known to resolve (verified
    # before the warehouse was written): joins that neither filter nor add a
    # column can then be left out.
    fk_checked: bool = False
    # Optional: builds the fact already joined with a (filtered) customer
    # dimension ``customer_key, fiscal_code_hash, province``, when the fact is
    # itself a join and the customer key lives on its smaller side.
    fact_with_customers: "Callable[[DataFrame], DataFrame] | None" = None


def _parse_day(value, name: str) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.date.fromisoformat(str(value))
    except ValueError as exc:  # malformed period text fails on the driver, clearly
        raise ValueError(f"{name} must be an ISO date YYYY-MM-DD, got {value!r}") from exc


@dataclass(frozen=True)
class KpiParams:
    """Period (required, both ends inclusive) and optional filters. Only
    ``None`` switches a filter off; an empty string is a real value."""

    period_start: dt.date
    period_end: dt.date
    province: str | None = None
    category: str | None = None

    @classmethod
    def of(cls, period_start, period_end, province=None, category=None) -> "KpiParams":
        return cls(_parse_day(period_start, "period_start"), _parse_day(period_end, "period_end"),
                   province, category)

    @property
    def days(self) -> int:
        return (self.period_end - self.period_start).days


# Warehouse schemas (explicit, never inferred).
TIME_DIM_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType(), False),
    T.StructField("full_date", T.DateType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("month_name_it", T.StringType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_name_it", T.StringType(), False),
    T.StructField("is_weekend", T.IntegerType(), False),
    T.StructField("is_holiday_it", T.IntegerType(), False),
    T.StructField("holiday_name_it", T.StringType(), True),
    T.StructField("is_summer", T.IntegerType(), False),
])

CUSTOMER_DIM_COLUMNS = (
    "customer_key", "customer_id", "last_name", "first_name", "fiscal_code_hash", "birth_date",
    "email", "city", "province", "zip_code", "has_marketing_consent", "registration_datetime",
    "valid_from", "valid_to", "is_current",
)
SUPPLIER_DIM_COLUMNS = (
    "supplier_key", "supplier_id", "name", "category", "vat_number", "city", "province",
    "zip_code", "is_active",
)
OPERATOR_DIM_COLUMNS = (
    "operator_key", "operator_id", "last_name", "first_name", "email", "activity_type", "city",
    "province", "hire_date", "status",
)
FACT_COLUMNS = (
    "request_id", "customer_key", "supplier_key", "operator_key", "date_key", "price",
    "service_duration_minutes", "is_completed", "is_cancelled", "status", "hash_record",
    "request_datetime", "completed_datetime", "notes",
)

_TYPES = {
    T.LongType(): "customer_key customer_id supplier_key supplier_id operator_key operator_id request_id",
    T.IntegerType(): "has_marketing_consent is_current is_active date_key service_duration_minutes is_completed is_cancelled",
    T.DoubleType(): "price",
    T.DateType(): "birth_date hire_date",
    T.TimestampNTZType(): "registration_datetime valid_from valid_to request_datetime completed_datetime",
}
_TYPE_OF = {c: t for t, names in _TYPES.items() for c in names.split()}


def _contract(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, _TYPE_OF.get(c, T.StringType())) for c in columns])


# Names and types of the five stored tables (S11); other columns are text.
WAREHOUSE_SCHEMAS = {
    "time_dim": TIME_DIM_SCHEMA,
    "customer_dim": _contract(CUSTOMER_DIM_COLUMNS),
    "supplier_dim": _contract(SUPPLIER_DIM_COLUMNS),
    "operator_dim": _contract(OPERATOR_DIM_COLUMNS),
    "request_fact": _contract(FACT_COLUMNS),
}
