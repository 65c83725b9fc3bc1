import random

import pytest
from pyspark.sql import functions as F

from dimstar.operators.kpis import money_sum
from dimstar.operators.sketch import distinct_counts, hashed, in_sketch, key_sketch


@pytest.mark.parametrize("bits", [3, 15, 16, 22])
def test_keys_that_were_put_in_are_found(spark, bits):
    keys = spark.range(0, 3000, 3).repartition(5)
    sketch = key_sketch(keys, hashed("id"), bits)
    told = in_sketch(spark.range(3000), hashed("id"), sketch, "flag", bits)
    rows = told.collect()
    assert told.columns == ["id", "flag"] and len(rows) == 3000
    assert all(r.flag for r in rows if r.id % 3 == 0)
    others = sum(r.flag for r in rows if r.id % 3)
    assert others < 10 if bits == 22 else others > 20
    assert sketch.agg(F.max(F.length("bitmap"))).first()[0] == 4096


def test_empty_sketch_and_null_key(spark):
    empty = key_sketch(spark.range(0), hashed("id"))
    df = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert [r.flag for r in in_sketch(df, hashed("k"), empty, "flag").collect()] == [False, False]
    full = key_sketch(df, hashed("k"))
    assert [r.flag for r in in_sketch(df, hashed("k"), full, "flag").collect()] == [True, True]


def values(seed, n=4000):
    rng = random.Random(seed)
    hot = "h" * 64
    return [(rng.choice([None, hot, hot, f"{rng.randrange(600):064d}", f"u{i:063d}", f"v{i:063d}"]),) for i in range(n)]


@pytest.mark.parametrize("fingerprint", [None, "7", "xxhash64(h) % 4", "xxhash64(h) % 1000", "length(h)"])
@pytest.mark.parametrize("bits", [1, 27])
def test_distinct_values_are_exact_whatever_the_fingerprint(spark, fingerprint, bits):
    """Colliding fingerprints and a full sketch only move more rows to the second stage."""
    rows = values(bits)
    df = spark.createDataFrame(rows, "h string").repartition(7)
    got = distinct_counts(df, "h", fingerprint and F.expr(fingerprint), bits).first()
    assert (got.n_rows, got.n_distinct) == (len(rows), len({h for h, in rows if h is not None}))


def test_distinct_values_of_few_rows(spark):
    for rows in ([], [(None,)], [(None,), (None,)], [("",)], [("",), ("",), (None,)], [("a",), ("b",)]):
        got = distinct_counts(spark.createDataFrame(rows, "h string"), "h").first()
        assert (got.n_rows, got.n_distinct) == (len(rows), len({h for h, in rows if h is not None}))


def test_only_repeated_values_are_moved_whole(spark):
    """The first stage's exchange has fingerprints and counts; in the second
    one, values that are alone are the NULL group."""
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).unionByName(
        spark.range(40).select(F.sha2(F.lit("same"), 256).alias("h")))
    told = distinct_counts(df, "h")
    assert tuple(told.first()) == (20_040, 20_001)
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    first = plan[plan.index("Aggregate [number"):]
    assert "Aggregate [print" in first and "value" not in first.split("Aggregate [print")[1].split("\n")[0]


def test_amounts_beyond_18_digits_add_up(spark):
    df = spark.createDataFrame([(1e13,), (0.25,), (-1e13,), (2e15,), (-2e15,), (None,)], "price double")
    assert df.agg(money_sum("price").alias("s")).first().s == 0.25
