import os

from pyspark.sql import functions as F

import fixtures as FX
from dimstar.model import WAREHOUSE_SCHEMAS
from dimstar.plans import load as L
from dimstar.plans import versions as R


def _loaded(spark):
    return L.build(FX.customers(spark), FX.suppliers(spark), FX.operators(spark), FX.requests(spark), gate_limit=None)


def _files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/fact") for f in names if f.endswith(".parquet"))


def _months(path):
    return {f.split("date_month=")[1][:6] for f in _files(path)}


def _facts(spark, path, base):
    return sorted(map(tuple, R.read_fact(spark, path, base, WAREHOUSE_SCHEMAS["request_fact"]).drop("date_month").collect()), key=repr)


def _spread(loaded):
    """The fact's rows over three months."""
    month = F.when(F.col("request_id") % 3 == 0, 20250310).when(F.col("request_id") % 3 == 1, 20250411).otherwise(20260101)
    return L.Loaded(**{**loaded.__dict__, "fact": loaded.fact.withColumn("date_key", month.cast("int"))})


def test_second_load_of_the_same_input_writes_no_fact_file(spark, tmp_path):
    path = str(tmp_path)
    loaded = _spread(_loaded(spark))
    L.write_warehouse(loaded, path, check=False)
    first, files = L.current_version(spark, path)[0], _files(path)
    assert len(files) >= len(_months(path)) >= 2
    L.write_warehouse(_spread(_loaded(spark)), path, check=False)
    second = L.current_version(spark, path)[0]
    assert second != first and _files(path) == files
    assert _facts(spark, path, first) == _facts(spark, path, second) != []


def test_one_changed_request_rewrites_its_month(spark, tmp_path):
    path = str(tmp_path)
    loaded = _spread(_loaded(spark))
    L.write_warehouse(loaded, path, check=False)
    first, before = L.current_version(spark, path)[0], _files(path)
    one = loaded.fact.agg(F.min("request_id")).first()[0]
    changed = loaded.fact.withColumn("notes", F.when(F.col("request_id") == one, F.lit("changed")).otherwise(F.col("notes")))
    again = L.Loaded(**{**_loaded(spark).__dict__, "fact": changed})
    L.write_warehouse(again, path, check=False)
    second = L.current_version(spark, path)[0]
    new = set(_files(path)) - set(before)
    assert len({f.split("date_month=")[1][:6] for f in new}) == 1
    rows = {r[0]: r[-1] for r in _facts(spark, path, second)}
    assert rows[one] == "changed" and {r[0]: r[-1] for r in _facts(spark, path, first)}[one] != "changed"
    # a row that goes takes its month along, or the month disappears
    L.write_warehouse(L.Loaded(**{**_loaded(spark).__dict__, "fact": changed.where(F.col("request_id") != one)}), path, check=False)
    assert one not in {r[0] for r in _facts(spark, path, L.current_version(spark, path)[0])}


def test_pruning_keeps_what_is_referred_to(spark, tmp_path):
    path = str(tmp_path)
    loaded = _spread(_loaded(spark))
    L.write_warehouse(loaded, path, check=False)
    kept = _files(path)
    spark.range(1).write.parquet(f"{path}/v=20000101T000000-lost/time_dim")  # lost long ago, with a month of its own
    spark.range(1).write.parquet(f"{path}/fact/date_month=202503/w=20000101T000000-lost")
    spark.range(1).write.parquet(f"{path}/v=99990101T000000-running/time_dim")
    spark.range(1).write.parquet(f"{path}/fact/date_month=202503/w=99990101T000000-running")
    L.write_warehouse(_spread(_loaded(spark)), path, check=False)
    newest = L.current_version(spark, path)[0]
    assert L.prune_versions(spark, path, keep=1) == [newest]
    assert not os.path.exists(f"{path}/v=20000101T000000-lost") and os.path.exists(f"{path}/v=99990101T000000-running")
    left = _files(path)
    assert [f for f in left if "running" not in f] == kept and any("running" in f for f in left)
    assert len(_facts(spark, path, newest)) == loaded.fact.count()
    L.prune_versions(spark, path, keep=1, abandoned=True)
    assert _files(path) == kept and not os.path.exists(f"{path}/v=99990101T000000-running")


def test_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, "a"), (1, "a", ""), (1, "a", None)], "date_month int, x string, y string")
    hashes = [r[0] for r in df.select(R.row_hash(df)).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]
    one = {tuple(r) for r in R.month_digests(df).collect()}
    assert one == {tuple(r) for r in R.month_digests(df.orderBy("y")).collect()}
    assert one != {tuple(r) for r in R.month_digests(df.limit(3)).collect()}


def test_a_fact_without_rows(spark, tmp_path):
    loaded = _loaded(spark)
    empty = L.Loaded(**{**loaded.__dict__, "fact": loaded.fact.limit(0)})
    L.write_warehouse(empty, str(tmp_path), check=False)
    assert L.read_warehouse(spark, str(tmp_path)).fact.count() == 0
