"""Frames that several parts of a result read are stored once, without the shuffle files behind them."""

import gc
import os
import time

import fixtures as FX
import pytest
from pyspark.sql import functions as F

from dimstar import session as S
from dimstar.operators import joins as J
from dimstar.operators import segmented as SEG
from dimstar.operators import validation as V


def counted(spark, df):
    """``df`` and the number of times its rows were made."""
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return df.mapInArrow(rows, df.schema), made


def shuffle_files(spark):
    """Shuffle files that the session holds."""
    at = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(at.apply(i).getName().startswith("shuffle_") and at.apply(i).getName().endswith(".data") for i in range(at.size()))


def settled(spark):
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
    return shuffle_files(spark)


def test_stored_frame_holds_no_shuffle_files(spark):
    before = settled(spark)
    df = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("g")).count()
    kept = S.stored(df, "some")
    for _ in range(40):  # files are deleted in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.05)
    assert shuffle_files(spark) <= before
    assert kept.schema.names == df.schema.names and kept.count() == 7
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get(S._CLEANUP, None) in (None, "false", "true")


def test_released_shuffles_puts_the_setting_back(spark):
    before = spark.conf.get(S._CLEANUP, None)
    with pytest.raises(ValueError), S.released_shuffles(spark):
        assert spark.conf.get(S._CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(S._CLEANUP, None) == before


def test_stored_frames_go_with_the_last_plan_on_them(spark):
    kept = S.stored(spark.range(10).repartition(2), "some")
    path = S._STORED[-1][1].removeprefix("file:")
    derived = kept.where("id > 3")
    del kept
    gc.collect()
    spark._jvm.System.gc()
    S.sweep(spark)
    assert os.path.isdir(path) and derived.count() == 6
    del derived
    for _ in range(40):
        gc.collect()
        spark.range(1).count()
        spark._jvm.System.gc()
        S.sweep(spark)
        if not os.path.isdir(path):
            break
        time.sleep(0.05)
    assert not os.path.isdir(path)
    assert path not in [p.removeprefix("file:") for _, p, _ in S._STORED]


@pytest.mark.parametrize("most", [0, 1000])
def test_customers_are_made_once_and_do_not_move(spark, monkeypatch, most):
    monkeypatch.setattr(J, "BROADCAST_MAX_ROWS", most)
    rows = FX.customers(spark)
    want = sorted((str(r.id), str(r.reason)) for r in V.check_customers(rows).collect())
    n, (df, made) = rows.count(), counted(spark, rows)
    checked = V.check_customers(df)
    assert sorted((str(r.id), str(r.reason)) for r in checked.collect()) == want
    assert checked.where("reason is null").count() > 0 and made.value == n
    assert "hashpartitioning" not in checked._jdf.queryExecution().executedPlan().toString()


def test_totals_come_from_the_checked_rows(spark):
    frames = [counted(spark, f(spark)) for f in (FX.customers, FX.suppliers, FX.operators, FX.requests)]
    val = V.validate_all(*[df for df, _ in frames])
    more = spark.createDataFrame([("requests", "1", "malformed_value")], "table string, key string, reason string")
    totals = {r.table: r.n_total for r in val.with_rejected(more).totals.collect()}
    sizes = [f(spark).count() for f in (FX.customers, FX.suppliers, FX.operators, FX.requests)]
    assert totals == dict(zip(V.ENTITIES, [*sizes[:3], sizes[3] + 1], strict=True))
    assert (frames[0][1].value, frames[3][1].value) == (sizes[0], sizes[3])  # not read again for the totals


def test_suppliers_alone_do_not_check_the_others(spark):
    (customers, c), (requests, r) = counted(spark, FX.customers(spark)), counted(spark, FX.requests(spark))
    val = V.validate_all(customers, FX.suppliers(spark), FX.operators(spark), requests)
    assert val.quarantine_of("suppliers").count() + val.suppliers_ok.count() == FX.suppliers(spark).count()
    assert c.value == r.value == 0


def test_segments_are_stored_without_shuffle_files(spark):
    seg = SEG.segment(spark.range(100).select((F.col("id") % 3).alias("g"), "id"), ["g"], ["id"], 4, with_position=True)
    assert "parquet" in seg._jdf.queryExecution().executedPlan().toString().lower()
    rows = seg.collect()
    assert len(rows) == 100
    order = sorted(rows, key=lambda x: (x[SEG.SEG], x[SEG.POS]))
    assert [(x.g, x.id) for x in order] == sorted((x.g, x.id) for x in rows)


def test_checks_make_the_fact_once(spark, monkeypatch):
    """the four keys are read from one stored frame."""
    from conftest import SF_SMALL
    from dimstar.plans import registry_checks as RC

    seen = []
    monkeypatch.setattr(RC, "stored", lambda df, name: seen.append(df.columns) or S.stored(df, name))
    found = RC.check_fk_orphans(spark, SF_SMALL)
    assert sorted(r.fk for r in found.collect() if r.ok and r.orphans == 0) == sorted(seen[0])
    assert seen == [["customer_key", "supplier_key", "operator_key", "date_key"]]
    assert "request_datetime" not in found._jdf.queryExecution().optimizedPlan().toString()  # nothing of the fact is made again
