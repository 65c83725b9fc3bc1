import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import fixtures as FX
from dimstar.operators.intervals import interval_join, overlapping
from dimstar.plans import load as L

BASE = dt.datetime(2025, 1, 1)
PROBE, VERSION = "pid int, g string, t timestamp_ntz", "vid int, h string, f timestamp_ntz, u timestamp_ntz"


def brute(probes, versions):
    return sorted((p[0], v[0]) for p in probes for v in versions
                  if p[1] is not None and p[1] == v[1] and p[2] is not None and v[2] is not None
                  and v[2] <= p[2] and (v[3] is None or p[2] < v[3]))


def joined(spark, probes, versions, **more):
    df = interval_join(spark.createDataFrame(probes, PROBE), spark.createDataFrame(versions, VERSION), "g", "t", "h", "f", "u", **more)
    return sorted(tuple(r) for r in df.select("probe.pid", "version.vid").collect()), df


@pytest.mark.parametrize("seed, levels", [(1, 20), (2, 20), (3, 5), (4, 0), (5, 12)])
def test_every_version_against_the_range_join(spark, seed, levels):
    """A hot group, nested, equal, empty, reversed and endless intervals, NULLs."""
    rng = random.Random(seed)
    at = lambda: BASE + dt.timedelta(seconds=rng.choice([rng.randrange(40), rng.randrange(10**7)]), microseconds=rng.choice([0, 1, 999_999]))
    group = lambda: rng.choice(["hot"] * 4 + ["a", "b", None])
    probes = [(i, group(), rng.choice([at(), at(), None]) if i % 9 == 0 else at()) for i in range(300)]
    versions = [(i, group(), None if i % 31 == 0 else at(), rng.choice([None, at(), at(), at()])) for i in range(150)]
    versions += [(200, "a", BASE, BASE), (201, "a", BASE, BASE + dt.timedelta(microseconds=1)), (202, "a", BASE, BASE)]
    probes += [(900, "a", BASE), (901, "a", BASE + dt.timedelta(microseconds=1)), (902, "zz", BASE)]
    got, _ = joined(spark, probes, versions, levels=levels)
    want = brute(probes, versions)
    assert got == want and len(want) > 300


def test_verdict_case_and_empty_sides(spark):
    jan, dec, feb, mar, jun = (dt.datetime(2025, m, 1) for m in (1, 12, 2, 3, 6))
    versions = [(1, "p", jan, dec), (2, "p", feb, mar)]
    assert joined(spark, [(7, "p", jun), (8, "p", feb), (9, "p", dec)], versions)[0] == [(7, 1), (8, 1), (8, 2)]
    assert joined(spark, [], versions)[0] == [] and joined(spark, [(7, "p", jun)], [])[0] == []
    assert joined(spark, [(7, "p", jan - dt.timedelta(days=1))], versions)[0] == []


def test_times_without_zone_ignore_the_session_zone(spark):
    """The hour that daylight saving skips is an hour like any other."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        probes = [(i, "p", dt.datetime(2025, 3, 30, 1) + dt.timedelta(minutes=10 * i)) for i in range(18)]
        versions = [(i, "p", probes[i][2], probes[i][2] + dt.timedelta(minutes=25)) for i in range(0, 18, 3)]
        assert joined(spark, probes, versions)[0] == brute(probes, versions)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_it_is_an_equality_join(spark):
    """No nested loop and no condition-only join: AQE can split both sides."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, df = joined(spark, [(1, "a", BASE)], [(1, "a", BASE, None)])
        plan = df._jdf.queryExecution().executedPlan().toString()
        line = next(x for x in plan.splitlines() if "SortMergeJoin" in x)
        assert "_l#" in line and "_n#" in line and "_g#" in line
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_overlapping_groups(spark):
    d = lambda n: BASE + dt.timedelta(days=n)
    rows = [(1, "gap", d(0), d(1)), (2, "gap", d(2), None), (3, "nested", d(0), d(9)), (4, "nested", d(1), d(2)),
            (5, "nested", d(20), d(21)), (6, "tie", d(0), d(1)), (7, "tie", d(0), d(1)), (8, "open", d(0), None),
            (9, "open", d(5), d(6)), (10, "touch", d(0), d(1)), (11, "touch", d(1), d(2)), (12, "empty", d(0), d(0)), (13, "empty", d(0), d(3)),
            (14, None, d(0), None), (15, None, d(0), None)]
    got = overlapping(spark.createDataFrame(rows, VERSION), "h", "f", "u")
    assert sorted(r.h for r in got.collect()) == ["nested", "open", "tie"]


def test_load_raises_on_two_versions(spark, tmp_path):
    """Only if a request lies where two versions hold."""
    loaded = L.build(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark), gate_limit=None)
    dim = loaded.customer_dim

    def with_version(start, end):
        one = dim.where("customer_key = 1").withColumn("customer_key", F.lit(99).cast("bigint"))
        one = one.withColumn("valid_from", F.lit(start).cast("timestamp_ntz")).withColumn("valid_to", F.lit(end).cast("timestamp_ntz"))
        return L.Loaded(**{**loaded.__dict__, "customer_dim": dim.unionByName(one)})

    times = sorted(r.request_datetime for r in loaded.validated.requests_ok.collect())
    broken = with_version(times[0], times[0] + dt.timedelta(seconds=1))
    with pytest.raises(L.AmbiguousVersion, match="several customer versions"):
        L.write_warehouse(broken, str(tmp_path / "w"))
    assert L.complete_versions(spark, str(tmp_path / "w")) == []
    fine = with_version(times[-1] + dt.timedelta(days=900), times[-1] + dt.timedelta(days=901))
    L.check_single_versions(fine)  # overlaps the current version, but no request is there
