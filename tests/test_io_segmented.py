import datetime as dt
import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimstar.operators.segmented import ffill_in_group, lag_in_group, lead_in_group
from dimstar.sources import csv as CSV


def _hot(spark):
    # one hot group holding most rows, spread over many segments
    return spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 37).cast("string"))).alias("g"),
        F.col("id").alias("t"),
        F.when(F.col("id") % 11 == 0, F.col("id")).alias("v"))


def test_segmented_ops_equal_plain_windows(spark):
    df = _hot(spark)
    w = Window.partitionBy("g").orderBy("t")
    ref = df.select("g", "t", F.lead("t").over(w).alias("nx"), F.lag("t").over(w).alias("pv"),
                    F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ff"))
    a = lead_in_group(df, ["g"], ["t"], "t", "nx", "hn", num_segments=7)
    b = lag_in_group(df, ["g"], ["t"], "t", "pv", num_segments=7)
    c = ffill_in_group(df, ["g"], ["t"], "v", "ff", num_segments=7)
    got = (a.select("t", "nx", "hn").join(b.select("t", "pv"), "t").join(c.select("t", "ff"), "t"))
    exp = {r.t: (r.nx, r.pv, r.ff) for r in ref.collect()}
    rows = got.collect()
    assert len(rows) == 3000
    for r in rows:
        assert (r.nx, r.pv, r.ff) == exp[r.t]
        assert r.hn == (r.nx is not None)


def test_csv_dialect(spark):
    d = tempfile.mkdtemp(prefix="dimstar-csv-")
    path = os.path.join(d, "suppliers.csv")
    text = ('﻿id,name,category,vat_number,city,province,zip_code,email,phone,is_active\n'
            '1,"Scuola ""Stella""","driving_school",01234567890,Napoli,NA,00185,,,1\n'
            '2,"Multi\nline",motorization,00000000001,Roma,RM,00100,a@b.it,"",0\n'
            '3,Bad,medical_center,1,Roma,RM,00100,,,notanint\n')
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    df = CSV.read_entity(spark, path, "suppliers", keep_corrupt=True)
    good, bad = CSV.split_corrupt(df, "suppliers")
    rows = {r.id: r for r in good.collect()}
    assert rows[1].name == 'Scuola "Stella"' and rows[1].province == "NA" and rows[1].zip_code == "00185"
    assert rows[1].email is None and rows[1].vat_number == "01234567890"
    assert rows[2].name == "Multi\nline" and rows[2].is_active == 0
    assert [r.key for r in bad.collect()] == ["3"]


def test_csv_round_trip_keeps_types(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4, dt.datetime(2025, 2, 15, 10), None, "booked", 40.0, None, "a, \"b\"")],
        CSV.REQUESTS_SCHEMA)
    d = tempfile.mkdtemp(prefix="dimstar-csv-")
    CSV.write_entity(df, d)
    back = CSV.read_entity(spark, d, "requests")
    assert back.collect() == df.collect()


def test_csv_round_trip_random_text(spark):
    """Quotes, commas, newlines, non-ASCII text and 'NA' survive a write and a
    read; only NULL is written as the empty field."""
    import random

    rnd = random.Random(3)
    alphabet = ['a', 'Z', ' ', ',', '"', '\n', 'è', 'ß', '€', ';', "'", 'N', 'A']
    rows = []
    for i in range(200):
        notes = None if i % 7 == 0 else ("NA" if i % 11 == 0 else
                                         "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 30))))
        rows.append((i, 1, 1, 1, dt.datetime(2025, 1, 1, 8, 30, 5) + dt.timedelta(minutes=i), None,
                     "booked", round(rnd.uniform(1, 500), 2), None, notes))
    df = spark.createDataFrame(rows, CSV.REQUESTS_SCHEMA)
    d = tempfile.mkdtemp(prefix="dimstar-csv-")
    CSV.write_entity(df, d)
    back = {r.id: r for r in CSV.read_entity(spark, d, "requests").collect()}
    for r in rows:
        b = back[r[0]]
        assert (b.notes, b.price, b.request_datetime) == (r[9], r[7], r[4]), r[0]
