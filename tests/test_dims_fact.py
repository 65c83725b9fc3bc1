import datetime as dt
import hashlib

from pyspark.sql import functions as F

import fixtures as FX
from dimstar.functions.calendar import week_label
from dimstar.functions.hashing import hash_record
from dimstar.operators import fact as FT
from dimstar.operators import validation as V
from dimstar.operators.dims import (build_customer_dim_scd2, build_operator_dim, build_supplier_dim,
                                    build_time_dim, scd2_stats)
from dimstar.operators.keys import dense_keys

T = dt.datetime


def _validated(spark):
    return V.validate_all(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark))


def test_scd2_versions_and_keys(spark):
    dim = build_customer_dim_scd2(_validated(spark).customers_ok)
    rows = [(r.customer_key, r.customer_id, r.valid_from, r.valid_to, r.is_current)
            for r in dim.orderBy("customer_key").collect()]
    assert rows == [
        (1, 1, T(2025, 1, 10, 9), T(2025, 3, 1, 10), 0),
        (2, 2, T(2025, 3, 1, 10), None, 1),
        (3, 11, T(2025, 2, 1, 8), None, 1),
    ]
    st = scd2_stats(dim).collect()[0]
    assert (st.n_personas, st.n_personas_multi, st.n_rows, st.n_current) == (2, 1, 3, 2)


def test_asof_uses_version_valid_at_request_time(spark):
    val = _validated(spark)
    dim = build_customer_dim_scd2(val.customers_ok)
    res = FT.resolve_customer_key(val.requests_ok, val.customers_ok, dim)
    keys = {r.id: r.customer_key for r in res.collect()}
    assert keys[1] == 1  # historic version although customer_id is 2
    assert keys[2] == 2  # valid_from inclusive, valid_to exclusive
    assert keys[13] == 2 and keys[14] == 1 and keys[20] == 1
    card = FT.asof_cardinality(res).collect()[0]
    assert card.n_unmatched == 0 and card.n_probes == 5


def test_asof_gap_and_ties(spark):
    versions = spark.createDataFrame([
        ("p", T(2025, 1, 1), T(2025, 1, 1), 1),   # zero-length version (tie)
        ("p", T(2025, 1, 1), T(2025, 2, 1), 2),
        ("p", T(2025, 3, 1), None, 3),             # gap between Feb and Mar
    ], "g string, valid_from timestamp_ntz, valid_to timestamp_ntz, k int")
    probes = spark.createDataFrame([
        (1, "p", T(2024, 12, 31)), (2, "p", T(2025, 1, 1)), (3, "p", T(2025, 2, 15)),
        (4, "p", T(2025, 3, 1)), (5, "q", T(2025, 3, 1)), (6, None, T(2025, 3, 1)),
    ], "id int, g string, t timestamp_ntz")
    out = FT.asof_join(probes, versions, "g", "t", "g", take=["k"], version_order=["k"])
    got = {r.id: r.k for r in out.collect()}
    assert got == {1: None, 2: 2, 3: None, 4: 3, 5: None, 6: None}


def test_fact_build_and_hash(spark):
    val = _validated(spark)
    cdim = build_customer_dim_scd2(val.customers_ok)
    fact = FT.build_request_fact(val.requests_ok, val.customers_ok, cdim, build_supplier_dim(val.suppliers_ok),
                                 build_operator_dim(val.operators_ok))
    r1 = fact.where("request_id = 1").collect()[0]
    assert r1.hash_record == "635aa908aefa226fcdc59c03c9fbbb5bcf1b77f8ee16286d8fddf4224e23c7f0"
    assert (r1.date_key, r1.is_completed, r1.is_cancelled, r1.customer_key) == (20250215, 1, 0, 1)
    assert fact.count() == 5
    assert FT.hash_uniqueness(fact).collect()[0].n_rows == 5


def test_hash_null_keeps_separators(spark):
    df = spark.createDataFrame([(None, "x", 1)], "a string, b string, c int")
    got = df.select(hash_record("a", "b", "c").alias("h")).collect()[0].h
    assert got == hashlib.sha256(b"|x|1").hexdigest()
    assert got == "d426ed0df1534340db7cf17167ecdb930fc23d2e85732a28493cf3c8bd75c577"


def test_dedup_by_hash_keeps_smallest_id(spark):
    df = spark.createDataFrame([(3, "h1", 1.0), (1, "h1", 2.0), (2, "h2", 3.0)],
                               "request_id int, hash_record string, price double")
    got = sorted((r.request_id, r.price) for r in FT.dedup_by_hash(df).collect())
    assert got == [(1, 2.0), (2, 3.0)]


CAL = [
    (dt.date(2024, 1, 1), 1, "2024-W01", 0, "Capodanno", 0),
    (dt.date(2024, 12, 30), 1, "2024-W53", 0, None, 0),
    (dt.date(2025, 1, 1), 3, "2025-W00", 0, "Capodanno", 0),
    (dt.date(2025, 1, 5), 7, "2025-W00", 1, None, 0),
    (dt.date(2025, 1, 6), 1, "2025-W01", 0, None, 0),
    (dt.date(2025, 4, 20), 7, "2025-W15", 1, "Pasqua", 0),
    (dt.date(2025, 7, 1), 2, "2025-W26", 0, None, 1),
    (dt.date(2025, 8, 15), 5, "2025-W32", 0, "Ferragosto", 1),
    (dt.date(2026, 12, 31), 4, "2026-W52", 0, None, 0),
]


def test_calendar_fixtures(spark):
    td = build_time_dim(spark, dt.date(2024, 1, 1), dt.date(2026, 12, 31))
    rows = {r.full_date: r for r in td.withColumn("wk", week_label("full_date")).collect()}
    for d, dow, wk, we, hol, summer in CAL:
        r = rows[d]
        assert (r.day_of_week, r.wk, r.is_weekend, r.holiday_name_it, r.is_summer) == (dow, wk, we, hol, summer), d
        assert r.is_holiday_it == (1 if hol else 0)
    assert build_time_dim(spark).count() == 730


def test_week_label_matches_python_strftime(spark):
    td = build_time_dim(spark, dt.date(2000, 1, 1), dt.date(2040, 12, 31))
    got = {r.full_date: r.wk for r in td.select("full_date", week_label("full_date").alias("wk")).collect()}
    assert len(got) == 14976
    assert all(v == k.strftime("%Y-W%W") for k, v in got.items())


def test_holiday_precedence(spark):
    td = build_time_dim(spark, dt.date(2025, 4, 24), dt.date(2025, 4, 26), {"2025-04-25": "Moved"})
    names = {r.full_date: r.holiday_name_it for r in td.collect()}
    assert names[dt.date(2025, 4, 25)] == "Moved"


def test_dense_keys_across_partitions(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    out = dense_keys(df, ["g", "v"], "k", num_partitions=5)
    rows = out.orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 1001))
    assert [(r.g, r.v) for r in rows] == sorted((r.g, r.v) for r in rows)
    # the numbered rows stay spread over the range partitions (no single-partition sort)
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_asof_hot_group_equals_range_join(spark):
    """One persona holds most probes and versions; the segmented as-of join
    must equal the brute-force range join."""
    n_v, n_p = 400, 4000
    versions = spark.range(n_v).select(
        F.when(F.col("id") < 300, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 17).cast("string"))).alias("g"),
        (F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 37) % 5000)).alias("valid_from"),
        F.col("id").alias("k"))
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("g").orderBy("valid_from", "k")
    versions = versions.withColumn("valid_to", F.lead("valid_from").over(w))
    probes = spark.range(n_p).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") < 3000, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 19).cast("string"))).alias("g"),
        (F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 13) % 5200)).alias("t"))
    got = {r.pid: r.k for r in FT.asof_join(probes, versions, "g", "t", "g", take=["k"], version_order=["k"]).collect()}
    brute = probes.alias("p").join(
        versions.alias("v"),
        (F.col("p.g") == F.col("v.g")) & (F.col("v.valid_from") <= F.col("p.t"))
        & (F.col("v.valid_to").isNull() | (F.col("p.t") < F.col("v.valid_to"))), "left")
    exp = {}
    for r in brute.select("p.pid", "v.k").collect():
        assert r.pid not in exp or exp[r.pid] is None  # at most one version matches
        exp[r.pid] = r.k
    assert got == exp


def test_scd2_and_asof_random(spark):
    """Random registrations (with ties) and probes: SCD2 versions and the
    as-of lookup equal a plain-Python reading of the half-open intervals."""
    import random

    rnd = random.Random(11)
    regs = [(i, f"p{rnd.randint(0, 8)}", T(2025, 1, 1) + dt.timedelta(hours=rnd.randint(0, 40)))
            for i in range(300)]
    df = spark.createDataFrame(regs, "id int, g string, ts timestamp_ntz")
    from dimstar.operators.dims import scd2_versions
    got = {r.id: (r.valid_to, r.is_current) for r in
           scd2_versions(df, persona="g", ts="ts", tiebreak="id").collect()}
    exp = {}
    by = {}
    for i, g, ts in sorted(regs, key=lambda r: (r[1], r[2], r[0])):
        by.setdefault(g, []).append((i, ts))
    for g, vs in by.items():
        for k, (i, ts) in enumerate(vs):
            exp[i] = (vs[k + 1][1] if k + 1 < len(vs) else None, 1 if k + 1 == len(vs) else 0)
    assert got == exp

    versions = spark.createDataFrame(
        [(g, ts, exp[i][0], i) for i, g, ts in regs],
        "g string, valid_from timestamp_ntz, valid_to timestamp_ntz, k int")
    probes = [(j, f"p{rnd.randint(0, 9)}", T(2025, 1, 1) + dt.timedelta(hours=rnd.randint(-2, 44)))
              for j in range(500)]
    pdf = spark.createDataFrame(probes, "pid int, g string, t timestamp_ntz")
    got = {r.pid: r.k for r in FT.asof_join(pdf, versions, "g", "t", "g", take=["k"], version_order=["k"]).collect()}
    vmap = {}
    for i, g, ts in regs:
        vmap.setdefault(g, []).append((ts, exp[i][0], i))
    exp2 = {}
    for j, g, t in probes:
        hits = [k for (vf, vt, k) in vmap.get(g, []) if vf <= t and (vt is None or t < vt)]
        assert len(hits) <= 1
        exp2[j] = hits[0] if hits else None
    assert got == exp2


def test_dedup_hot_hash_random(spark):
    """A third of the rows share one hash, some hashes are NULL: dedup keeps
    the smallest id per hash (NULLs form one group), whole rows intact."""
    import random

    rnd = random.Random(17)
    rows = []
    for i in range(3000):
        h = "hot" if i % 3 == 0 else rnd.choice([None, *[f"h{k}" for k in range(200)]])
        rows.append((rnd.randint(0, 10 ** 9) * 10 + i % 10, h, float(i)))
    df = spark.createDataFrame(rows, "request_id long, hash_record string, price double").repartition(9)
    best = {}
    for r in rows:
        if r[1] not in best or r[0] < best[r[1]][0]:
            best[r[1]] = r
    got = sorted(tuple(r) for r in FT.dedup_by_hash(df).collect())
    assert got == sorted(best.values(), key=lambda r: tuple(r))
    u = FT.hash_uniqueness(df).collect()[0]
    assert (u.n_rows, u.n_distinct_hash) == (3000, len([h for h in best if h is not None]))


def test_calendar_columns_exhaustive():
    """Every column of the reference calendar (730 days) against plain Python."""
    from dimstar.functions.constants import (DAY_NAMES_IT, EASTER_DATES_IT, FIXED_HOLIDAYS_IT,
                                             MONTH_NAMES_IT)
    from dimstar.session import local_session
    spark = local_session()
    rows = build_time_dim(spark).collect()
    assert len(rows) == 730
    for r in rows:
        d = r.full_date
        hol = EASTER_DATES_IT.get(d.isoformat()) or FIXED_HOLIDAYS_IT.get(d.strftime("%m-%d"))
        assert r.date_key == int(d.strftime("%Y%m%d"))
        assert (r.day, r.month, r.year, r.quarter) == (d.day, d.month, d.year, (d.month - 1) // 3 + 1)
        assert r.month_name_it == MONTH_NAMES_IT[d.month - 1]
        assert (r.day_of_week, r.day_name_it) == (d.isoweekday(), DAY_NAMES_IT[d.weekday()])
        assert r.is_weekend == (1 if d.weekday() >= 5 else 0)
        assert (r.holiday_name_it, r.is_holiday_it) == (hol, 1 if hol else 0)
        assert r.is_summer == (1 if d.month in (7, 8, 9) else 0)


def test_asof_matches_of_overlapping_intervals(spark):
    import datetime as dt
    import random

    rng = random.Random(6)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    versions = [(rng.choice("abc") if rng.random() < 0.95 else None, None if rng.random() < 0.05 else day(rng.randrange(40)),
                 None if rng.random() < 0.1 else day(rng.randrange(50))) for _ in range(200)]
    probes = [(i, rng.choice(["a", "a", "a", "b", "c", "z", None]), None if i % 37 == 0 else day(rng.randrange(-2, 55)))
              for i in range(400)]
    expected = {i: sum(g == vg and g is not None and t is not None and f is not None and f <= t and (u is None or t < u)
                       for vg, f, u in versions) for i, g, t in probes}
    got = FT.asof_matches(spark.createDataFrame(probes, "pid int, g string, t timestamp_ntz"),
                          spark.createDataFrame(versions, "g string, valid_from timestamp_ntz, valid_to timestamp_ntz"),
                          "g", "t", "g")
    assert {r.pid: r.n_matches for r in got.collect()} == expected
    classes = {r.matches: r.n_probes for r in FT.asof_match_classes(got).collect()}
    assert classes["none"] == sum(n == 0 for n in expected.values()) and sum(classes.values()) == 400


def test_hot_persona_joins_can_be_split(spark):
    """An aggregate joined back on its key keeps an exchange on both sides, so
    AQE splits the hot key."""
    from pyspark.sql import functions as F


    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                                                "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                                "spark.sql.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1" if "Broadcast" in k else "1k")
    try:
        rows = spark.range(0, 20_000).select(
            F.col("id"), F.sha2(F.concat(F.lit("x"), "id"), 512).alias("pad"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("p"))
        first = rows.groupBy(F.col("p").alias("_p")).agg(F.min("id").alias("m"))
        df = rows.repartition(8).join(first, F.col("p").eqNullSafe(F.col("_p")))
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
