"""Stored aggregates of the star, and KPIs answered from them.

Two tables, both far smaller than the fact and read instead of it:

* ``measures``: sums and counts per (day, province, category, supplier). Every
  additive KPI of any period and filter is a sum over its rows.
* ``personas``: who had requests, as bitmaps of dense persona numbers per (day
  or whole month, province, category). A bitmap covers one bucket of 32,768
  numbers. ``once`` has the personas with a request, ``twice`` those with two
  or more. Distinct personas are the set bits of the union; two pairs merge to
  (union, both twice sets and whoever is in both unions), so returning personas
  of any period come from the same rows. A period reads the months that it
  covers whole and the days at its ends.

``answer`` takes a parameter pack and uses the aggregates where the pack lies
inside what they were built for, and the star otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import week_label
from ..model import KpiParams, Star
from . import kpis as K
from .keys import dense_keys

MEASURES = ["date_key", "province", "category", "supplier_key", "n_requests", "n_done", "amount", "dur_sum", "dur_n", "n_cancelled"]
TASK_ROWS = 500_000  # rows that one task groups, whatever the input's size
_PAIR = "bucket bigint, once binary, twice binary"


@dataclass(frozen=True)
class Aggregates:
    measures: DataFrame
    personas: DataFrame
    supplier_dim: DataFrame
    period: tuple[dt.date, dt.date]

    def covers(self, p: KpiParams) -> bool:
        return self.period[0] <= p.period_start and p.period_end <= self.period[1]


def base_rows(star: Star, period: tuple[dt.date, dt.date]) -> DataFrame:
    """The rows of the period that both tables are made of, with ``date_month``
    and the persona's dense number (NULL without a hash). The number is joined
    with the customer dimension and takes the hash's place there, so the fact
    is neither joined once more nor moved with a hash."""
    customers = star.customer_dim.join(persona_numbers(star.customer_dim), "fiscal_code_hash", "left").select(
        "customer_key", F.col("persona").alias("fiscal_code_hash"), "province")
    rows = K.filtered_star(replace(star, customer_dim=customers), KpiParams.of(*period))
    return rows.select((F.col("date_key") / 100).cast("int").alias("date_month"), "date_key", "province", "category",
                       "supplier_key", F.col("fiscal_code_hash").alias("persona"), "price", "service_duration_minutes",
                       "is_completed", "is_cancelled")


def tasks_for(rows: DataFrame) -> int:
    """Tasks that the rows are grouped in: the session's shuffle partitions,
    and more where a task would have more than ``TASK_ROWS`` rows."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))


def build_measures(rows: DataFrame, tasks: int) -> DataFrame:
    """One row per day, province, category and supplier with requests. A month
    goes to one task, or to several by supplier as the tasks become many: they
    write its folder."""
    done = (F.col("is_cancelled") == 0) & (F.col("is_completed") == 1)
    piece = F.pmod(F.xxhash64("supplier_key"), F.lit(max(tasks // 32, 1))).alias("_piece")
    dealt = rows.drop("persona").select("*", piece).repartition(tasks, "date_month", "_piece")
    return dealt.groupBy("date_month", "_piece", "date_key", "province", "category", "supplier_key").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count_if(done).alias("n_done"),
        F.sum(F.when(done, F.col("price").cast(K.MONEY))).alias("amount"),
        F.sum(F.when(done, F.col("service_duration_minutes")).cast("bigint")).alias("dur_sum"),
        F.count(F.when(done, F.col("service_duration_minutes"))).alias("dur_n"),
        F.sum("is_cancelled").cast("bigint").alias("n_cancelled")).select(*MEASURES, "date_month")


def persona_numbers(customer_dim: DataFrame) -> DataFrame:
    """``fiscal_code_hash, persona``: dense numbers from 1. Personas of one
    province are neighbours, so a province's cells touch few buckets."""
    one = customer_dim.groupBy("fiscal_code_hash").agg(F.min("province").alias("_home"))
    return dense_keys(one, ["_home", "fiscal_code_hash"], "persona").select("fiscal_code_hash", "persona")


def build_persona_bitmaps(rows: DataFrame, period: tuple[dt.date, dt.date], tasks: int) -> DataFrame:
    """``level, date_key, province, category, bucket, once, twice``; level is
    'day', or 'month' with the month's first ``date_key`` (only months that
    the period covers whole); ``twice`` is NULL if nobody is in it.

    A month's rows of one province, category and bucket are in one task, which
    holds all days of the cell and the month: the persona numbers are moved
    once, and no bitmap is moved."""
    cell = ["date_month", "province", "category", "bucket"]
    numbers = rows.where(F.col("persona").isNotNull()).select(
        "date_month", "date_key", "province", "category", F.bitmap_bucket_number("persona").alias("bucket"), "persona")
    months = [int(f"{m:%Y%m}") for m in _whole_months(*period)]
    day = F.struct(F.lit("day").alias("level"), F.col("date_key").alias("date_key"))
    month = F.struct(F.lit("month").alias("level"), (F.col("date_month") * 100 + 1).cast("int").alias("date_key"))
    of = F.when(F.col("date_month").isin(months), F.array(day, month)).otherwise(F.array(day)) if months else F.array(day)
    counts = (numbers.repartition(tasks, *cell).select(*cell, "persona", F.inline(of))
              .groupBy("level", "date_key", *cell, "persona").agg(F.count(F.lit(1)).alias("n")))
    return counts.groupBy("level", "date_key", *cell).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("persona")).alias("once"),
        # most cells have nobody twice: no bitmap then
        F.when(F.max("n") >= 2, F.expr("bitmap_construct_agg(bitmap_bit_position(persona)) FILTER (WHERE n >= 2)")).alias("twice")
    ).select("level", "date_key", "province", "category", "bucket", "once", "twice")


def _whole_months(start: dt.date, end: dt.date) -> list[dt.date]:
    """First days of the months that lie in the period from start to end."""
    out, m = [], start.replace(day=1)
    while m <= end:
        after = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        if m >= start and after - dt.timedelta(days=1) <= end:
            out.append(m)
        m = after
    return out


def _key(d: dt.date) -> int:
    return d.year * 10_000 + d.month * 100 + d.day


def _filtered(df: DataFrame, p: KpiParams) -> DataFrame:
    for name, value in (("province", p.province), ("category", p.category)):
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def _measures(a: Aggregates, p: KpiParams) -> DataFrame:
    lo, hi = _key(p.period_start), _key(p.period_end)
    rows = a.measures.where(F.col("date_key").between(lo, hi))
    if "date_month" in a.measures.columns:
        rows = rows.where(F.col("date_month").between(lo // 100, hi // 100))
    return _filtered(rows, p)


def _personas(a: Aggregates, p: KpiParams) -> DataFrame:
    """The rows of the period: whole months, and the days outside of them."""
    whole = _whole_months(p.period_start, p.period_end)
    day, month = F.col("level") == "day", F.col("level") == "month"
    key = F.col("date_key")
    if not whole:
        wanted = day & key.between(_key(p.period_start), _key(p.period_end))
    else:
        before = key.between(_key(p.period_start), _key(whole[0]) - 1)
        after = (key > _key(whole[-1]) + 30) & (key <= _key(p.period_end))
        wanted = (month & key.between(_key(whole[0]), _key(whole[-1]))) | (day & (before | after))
    return _filtered(a.personas.where(wanted), p)


def _merged_pairs(rows: DataFrame) -> DataFrame:
    """One pair of bitmaps per bucket. Each task folds its rows into one pair
    per bucket first, so a bucket then has at most one row per task."""
    def merge(pairs: dict, bucket: int, once: bytes, twice: bytes) -> None:
        o, t = np.frombuffer(once, np.uint8), np.frombuffer(twice or bytes(len(once)), np.uint8)
        if bucket in pairs:
            held = pairs[bucket]
            held[1] |= t | (held[0] & o)
            held[0] |= o
        else:
            pairs[bucket] = [o.copy(), t.copy()]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict = {}
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                merge(pairs, *row)
        for bucket, (once, twice) in pairs.items():
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([once.tobytes()], pa.binary()),
                                              pa.array([twice.tobytes()], pa.binary())], ["bucket", "once", "twice"])

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        pairs: dict = {}
        for row in zip(rows["bucket"], rows["once"], rows["twice"], strict=True):
            merge(pairs, *row)
        return pd.DataFrame([(b, o.tobytes(), t.tobytes()) for b, (o, t) in pairs.items()], columns=["bucket", "once", "twice"])

    partial = rows.select("bucket", "once", "twice").mapInArrow(fold, _PAIR)
    return partial.groupBy("bucket").applyInPandas(last, _PAIR)


def _ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b, F.lit(0))


def _active(a: Aggregates, p: KpiParams) -> DataFrame:
    union = _personas(a, p).groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("once")).alias("n"))
    return union.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("value"))


def _returning(a: Aggregates, p: KpiParams) -> DataFrame:
    counts = _merged_pairs(_personas(a, p)).select(F.bitmap_count("once").alias("n"), F.bitmap_count("twice").alias("again"))
    return counts.agg(_ratio(F.sum("again"), F.sum("n")).alias("value"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))


_SUMS = {
    "n_requests": lambda: F.coalesce(F.sum("n_requests"), F.lit(0)).cast("bigint"),
    "revenue": lambda: F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)),
    "mean_duration": lambda: _ratio(F.sum("dur_sum"), F.sum("dur_n")),
    "cancel_rate": lambda: _ratio(F.sum("n_cancelled"), F.sum("n_requests")),
}


def _value(name: str, reason: str | None):
    return lambda a, p: K.envelope(_measures(a, p).agg(_SUMS[name]().alias("value")), p, reason)


def _summary(a: Aggregates, p: KpiParams) -> DataFrame:
    sums = _measures(a, p).agg(*[f().alias(n) for n, f in _SUMS.items()]).withColumn("_one", F.lit(1))
    people = _returning(a, p).select(F.col("n").alias("active_customers"), F.col("value").alias("retention"), F.lit(1).alias("_one"))
    # one row each
    return sums.join(people, "_one").select(
        "n_requests", "revenue", "mean_duration", "active_customers", "cancel_rate", "retention",
        F.lit(p.period_start).alias("period_start"), F.lit(p.period_end).alias("period_end"),
        F.lit(p.province).cast("string").alias("province"), F.lit(p.category).cast("string").alias("category"))


def _by_province(a: Aggregates, p: KpiParams) -> DataFrame:
    return (_measures(a, p).where("n_done > 0").groupBy("province")
            .agg(F.sum("amount").cast("double").alias("revenue_in_province"), F.sum("n_done").alias("n_requests_in_province"))
            .orderBy(F.col("revenue_in_province").desc(), F.col("province").asc_nulls_first()))


def _trend(label):
    def run(a: Aggregates, p: KpiParams) -> DataFrame:
        day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
        return (_measures(a, p).withColumn("full_date", day).groupBy(label("full_date").alias("period_label"))
                .agg(F.sum("n_requests").alias("n_requests")).orderBy("period_label"))
    return run


def _top(a: Aggregates, p: KpiParams, k: int = 5) -> DataFrame:
    totals = _measures(a, p).where("n_done > 0").groupBy("supplier_key").agg(
        F.sum("amount").cast("double").alias("revenue_eur"), F.sum("n_done").alias("n_requests"))
    named = a.supplier_dim.select("supplier_key", F.col("name").alias("supplier_name"), "category")
    best = totals.orderBy(F.col("revenue_eur").desc(), F.col("supplier_key").asc()).limit(k)
    return best.join(named, "supplier_key").orderBy(F.col("revenue_eur").desc(), F.col("supplier_key").asc()) \
               .select("supplier_name", "category", "revenue_eur", "n_requests")


def _cells(a: Aggregates, p: KpiParams) -> DataFrame:
    return (_measures(a, p).groupBy("province", "category").agg(F.sum("n_requests").alias("n_requests"))
            .orderBy("province", "category"))


FROM_AGGREGATES = {
    "request_count": _value("n_requests", None),
    "revenue": _value("revenue", None),
    "mean_duration": _value("mean_duration", K.REASON_NO_COMPLETED),
    "cancel_rate": _value("cancel_rate", K.REASON_NO_DENOMINATOR),
    "active_customers": lambda a, p: K.envelope(_active(a, p), p, None),
    "retention": lambda a, p: K.envelope(_returning(a, p), p, K.REASON_NO_DENOMINATOR),
    "summary": _summary,
    "revenue_by_province": _by_province,
    "trend_daily": _trend(lambda c: F.date_format(c, "yyyy-MM-dd")),
    "trend_weekly": _trend(week_label),
    "top_suppliers": _top,
    "province_category": _cells,
}


def answer(star: Star, aggregates: Aggregates | None, p: KpiParams, name: str) -> DataFrame:
    """K8: the named KPI, from the aggregates where they cover the pack's
    period, from the star otherwise; the rows are the same."""
    if name == "trend":
        name = "trend_weekly" if K.trend_granularity(p) == "weekly" else "trend_daily"
    if aggregates is not None and aggregates.covers(p):
        return FROM_AGGREGATES[name](aggregates, p)
    return K.kpi_named(star, p, name)
