import gc
import os
import shutil
import time

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from dimstar.session import keep, kept_with
from dimstar.sources import driver


def persisted(spark):
    for _ in range(40):  # unpersisting does not block
        gc.collect()
        n = spark.sparkContext._jsc.getPersistentRDDs().size()
        if not n:
            return 0
        time.sleep(0.1)
    return n


@pytest.mark.parametrize("name", ["rules_requests", "reject_profile", "request_fact", "check_report", "fk_orphans_partial"])
def test_nothing_stays_persisted(spark, name):
    spark.catalog.clearCache()
    df = E.queries()[name](spark, SF_SMALL)
    df.count()
    del df
    assert persisted(spark) == 0


def test_a_failed_build_releases_too(spark):
    spark.catalog.clearCache()

    @kept_with
    def build():
        keep(spark.range(10)).count()
        raise ValueError("no result")

    with pytest.raises(ValueError):
        build()
    assert persisted(spark) == 0


def test_derived_frames_stay_right(spark):
    @kept_with
    def build():
        return keep(spark.range(10)).where("id > 3")

    derived = build().where("id < 8")
    gc.collect()
    assert derived.count() == 4


def test_rewritten_tables_are_read_again(spark, tmp_path):
    path = str(tmp_path / "region.parquet")
    spark.range(3).write.parquet(path)
    assert driver.table(spark, str(tmp_path), "region").count() == 3
    assert driver.table(spark, str(tmp_path), "region") is driver.table(spark, str(tmp_path), "region")
    shutil.rmtree(path)
    time.sleep(1.1)
    spark.range(5).write.parquet(path)
    os.utime(path)
    assert driver.table(spark, str(tmp_path), "region").count() == 5


def test_gate_edge(spark):
    rows = {r.table: r for r in E.queries()["reject_gate_edge"](spark, SF_SMALL).collect()}
    assert rows["operators"].ko_ratio == 0.05 and rows["operators"].abort is False
    assert rows["requests"].abort is True  # suppliers are under it from 100 rows on
