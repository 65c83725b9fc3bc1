import datetime as dt

import pytest

import fixtures as FX
from conftest import SF_SMALL
from dimstar.model import KpiParams
from dimstar.operators import aggregates as A
from dimstar.operators import kpis as K
from dimstar.plans import load as L
from dimstar.session import scratch_path
from dimstar.sources import driver

PERIODS = [("1995-01-01", "2001-12-31"), ("1996-01-17", "1998-11-05"), ("1997-03-04", "1997-03-28"), ("1997-02-01", "1997-02-28"),
           ("1996-12-31", "1997-02-01"), ("2001-12-31", "2001-12-31")]


@pytest.fixture(scope="module")
def stored(spark):
    star = driver.driver_star(spark, SF_SMALL)
    base = scratch_path(spark, "aggregates-test")
    star.supplier_dim.write.parquet(f"{base}/supplier_dim")
    assert L.read_aggregates(spark, base) is None
    L.write_aggregates(star, base, driver.DRIVER_CALENDAR)
    return star, L.read_aggregates(spark, base)


@pytest.mark.parametrize("period", PERIODS)
def test_people_equal_the_exact_queries(spark, stored, period):
    """K4 and K7 by bitmaps, and K10, against the fact."""
    star, aggregates = stored
    for province, category in ((None, None), ("NATION_3", None), (None, "EUROPE"), ("NATION_3", "EUROPE"), ("ZZ", None)):
        p = KpiParams.of(*period, province, category)
        assert A.answer(star, aggregates, p, "summary").collect() == K.kpi_summary(star, p).collect()
        for name in ("active_customers", "retention"):
            assert A.answer(star, aggregates, p, name).collect() == K.kpi_named(star, p, name).collect(), (name, p)


@pytest.mark.parametrize("name", sorted(A.FROM_AGGREGATES))
def test_every_kpi(spark, stored, name):
    star, aggregates = stored
    p = KpiParams.of("1996-01-17", "1998-11-05", None, "ASIA")
    got, want = A.answer(star, aggregates, p, name), K.kpi_named(star, p, name)
    assert got.collect() == want.collect() and got.schema.simpleString() == want.schema.simpleString()


def test_the_fact_is_not_read(spark, stored):
    star, aggregates = stored
    p = KpiParams.of(*PERIODS[0])
    for name, read in (("revenue", ["agg_measures"]), ("active_customers", ["agg_personas"]), ("retention", ["agg_personas"])):
        files = A.answer(star, aggregates, p, name).inputFiles()
        assert files and {x for f in files for x in ("agg_measures", "agg_personas", "lineitem", "orders") if x in f} == set(read)
    outside = KpiParams.of("1994-12-31", "1996-01-01")
    assert any("lineitem" in f for f in A.answer(star, aggregates, outside, "revenue").inputFiles())
    assert A.answer(star, aggregates, outside, "revenue").collect() == K.kpi_revenue(star, outside).collect()
    assert any("lineitem" in f for f in A.answer(star, None, p, "revenue").inputFiles())


def test_periods_prune_months(spark, stored):
    star, aggregates = stored
    p = KpiParams.of("1996-01-17", "1996-02-05")
    assert len(A.answer(star, aggregates, p, "request_count").inputFiles()) >= 1
    plan = A.answer(star, aggregates, p, "request_count")._jdf.queryExecution().toString()
    assert "date_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_whole_months():
    d = dt.date
    assert A._whole_months(d(2024, 1, 31), d(2024, 3, 1)) == [d(2024, 2, 1)]
    assert A._whole_months(d(2024, 2, 1), d(2024, 2, 28)) == [] and A._whole_months(d(2024, 2, 1), d(2024, 2, 29)) == [d(2024, 2, 1)]
    assert A._whole_months(d(2024, 12, 1), d(2025, 1, 31)) == [d(2024, 12, 1), d(2025, 1, 1)]


def test_aggregates_of_a_written_warehouse(spark, tmp_path):
    loaded = L.build(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark), gate_limit=None)
    L.write_warehouse(loaded, str(tmp_path))
    base, _ = L.current_version(spark, str(tmp_path))
    star = L.read_warehouse(spark, str(tmp_path), loaded.calendar)
    L.write_aggregates(star, base, loaded.calendar)
    aggregates = L.read_aggregates(spark, base)
    p = KpiParams.of("2025-01-01", "2026-12-31")
    assert A.answer(star, aggregates, p, "summary").collect() == K.kpi_summary(star, p).collect()
    assert A.answer(star, aggregates, p, "trend").collect() == K.trend(star, p).collect()


def test_many_personas_and_buckets(spark):
    """Pairs of three buckets, folded in several tasks, against a plain count."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = [(c, rng.choice([5, 40_000, 70_001, rng.randrange(1, 90_000)])) for c in range(40) for _ in range(300)]
    df = spark.createDataFrame(rows, "cell int, persona long").groupBy("cell", "persona").agg(F.count(F.lit(1)).alias("n"))
    cells = df.groupBy("cell", F.bitmap_bucket_number("persona").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("persona")).alias("once"),
        F.when(F.max("n") >= 2, F.expr("bitmap_construct_agg(bitmap_bit_position(persona)) FILTER (WHERE n >= 2)")).alias("twice"))
    got = A._merged_pairs(cells.repartition(5)).select(F.sum(F.bitmap_count("once")), F.sum(F.bitmap_count("twice"))).first()
    per = {}
    for _, x in rows:
        per[x] = per.get(x, 0) + 1
    assert tuple(got) == (len(per), sum(n >= 2 for n in per.values()))


def test_rows_move_once_and_tasks_are_bounded(spark, monkeypatch):
    """each table is grouped behind one exchange of narrow rows; more rows, more tasks."""
    from collections import Counter

    from pyspark.sql import functions as F

    star = driver.driver_star(spark, SF_SMALL)
    rows = A.base_rows(star, driver.DRIVER_CALENDAR).localCheckpoint()
    monkeypatch.setattr(A, "TASK_ROWS", -(-rows.count() // 20))
    tasks = A.tasks_for(rows)
    assert tasks == 20
    bitmaps = A.build_persona_bitmaps(rows, driver.DRIVER_CALENDAR, tasks)
    for df in (A.build_measures(rows, tasks), bitmaps):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and f", {tasks}), REPARTITION_BY_NUM" in plan, plan
        assert "rangepartitioning" not in plan
    per = Counter((r.date_month, r.persona) for r in rows.where("persona is not null").collect())
    got = bitmaps.where("level = 'month'").groupBy().agg(F.sum(F.bitmap_count("once")).alias("n")).first().n
    cells = {(r.date_month, r.province, r.category, r.persona) for r in rows.where("persona is not null").collect()}
    assert got == len(cells) >= len(per)
