"""Versions of a warehouse (S10): which are complete, which month folders of
the fact each one consists of, and what can be deleted.

A version is a folder ``v=...`` with the dimensions, the quarantine and a
manifest of the fact; its last write is a marker. The fact's rows lie in
``fact/date_month=.../w=...``, one folder per month and version that wrote it.
The manifest names, per month, the folder and a digest of its rows that does
not depend on their order (count, sum and xor of row hashes). A rebuild writes
the months whose digest differs from the last complete version's, and refers
to the others where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DONE = "_complete"
FACT = "fact"
_MANIFEST = "date_month int, n bigint, total string, mixed bigint, w string, columns string"


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _found(spark: SparkSession, pattern: str) -> list[str]:
    at, files = _at(spark, pattern)
    return sorted(f.getPath().toString() for f in (files.globStatus(at) or []))


def _delete(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions, oldest first."""
    return [p[:-len(f"/{DONE}/_SUCCESS")] for p in _found(spark, f"{path.rstrip('/')}/v=*/{DONE}/_SUCCESS")]


def current_version(spark: SparkSession, path: str) -> tuple[str, bool]:
    """The newest complete version's folder and whether its keys were verified."""
    versions = complete_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version in {path}")
    row = spark.read.schema("fk_checked string").json(f"{versions[-1]}/{DONE}").first()
    return versions[-1], row["fk_checked"] == "true"


# --- the fact's months

def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row; a NULL is told from every value and place."""
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in df.columns])
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], nulls)


def month_digests(fact: DataFrame) -> DataFrame:
    """``date_month, n, total, mixed`` of a fact with ``date_month``."""
    hashed = fact.select("date_month", row_hash(fact).alias("h"))
    return hashed.groupBy("date_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).cast("string").alias("total"),
        F.bit_xor("h").alias("mixed"))


def _columns(fact: DataFrame) -> str:
    """Names and types; not nullability, which says nothing about the rows."""
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fact.schema)


def manifest(spark: SparkSession, version: str) -> list:
    """The months of a version's fact, one row each."""
    return spark.read.schema(_MANIFEST).json(f"{version}/fact_manifest").collect()


def write_fact(fact: DataFrame, path: str, version: str, max_records_per_file: int) -> list[int]:
    """Write the months of ``fact`` (with ``date_month``) that differ from the
    last complete version of the warehouse ``path``, and the manifest of
    ``version``. Returns the months written. One row per month comes back to
    the driver."""
    spark = fact.sparkSession
    path, name, columns = path.rstrip("/"), version.rsplit("=", 1)[1], _columns(fact)
    before = complete_versions(spark, path)
    known = {(r.date_month, r.n, r.total, r.mixed): r.w for r in (manifest(spark, before[-1]) if before else [])
             if r.columns == columns}
    months = month_digests(fact).collect()
    placed = [(r.date_month, r.n, r.total, r.mixed, known.get((r.date_month, r.n, r.total, r.mixed), name), columns) for r in months]
    changed = sorted(m for m, *_, w, _ in placed if w == name)
    if changed:
        (fact.where(F.col("date_month").isin(changed)).repartitionByRange("date_key", "request_id")
             .sortWithinPartitions("date_key", "request_id").withColumn("w", F.lit(name))
             .write.mode("append").option("maxRecordsPerFile", max_records_per_file)
             .partitionBy("date_month", "w").parquet(f"{path}/{FACT}"))
    spark.createDataFrame(placed, _MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{version}/fact_manifest")
    return changed


def read_fact(spark: SparkSession, path: str, version: str, schema: T.StructType) -> DataFrame:
    """The fact of a version; ``date_month`` is a partition column."""
    root = f"{path.rstrip('/')}/{FACT}"
    folders = [f"{root}/date_month={r.date_month}/w={r.w}" for r in manifest(spark, version)]
    whole = T.StructType([*schema.fields, T.StructField("date_month", T.IntegerType()), T.StructField("w", T.StringType())])
    if not folders:
        return spark.createDataFrame([], whole).drop("w")
    return spark.read.option("basePath", root).schema(whole).parquet(*folders).drop("w")


# --- cleaning

def prune_versions(spark: SparkSession, path: str, keep: int = 2, abandoned: bool = False) -> list[str]:
    """Delete all complete versions but the ``keep`` newest, the folders of
    rebuilds that were lost before the newest complete version began, and the
    months that no version left refers to. A rebuild that began later may
    still run: ``abandoned`` says that none does, and deletes those too.
    Returns the complete versions left."""
    path = path.rstrip("/")
    versions = complete_versions(spark, path)
    left = versions[-keep:] if keep else []
    newest = left[-1].rsplit("=", 1)[1] if left else ""
    old = lambda name: abandoned or not left or name <= newest
    for folder in _found(spark, f"{path}/v=*"):
        if folder not in left and (folder in versions or old(folder.rsplit("=", 1)[1])):
            _delete(spark, folder)
    used = {f"date_month={r.date_month}/w={r.w}" for v in left for r in manifest(spark, v)}
    for folder in _found(spark, f"{path}/{FACT}/date_month=*/w=*"):
        month, w = folder.rsplit("/", 2)[1:]
        if f"{month}/{w}" not in used and old(w.split("=", 1)[1]):
            _delete(spark, folder)
    return complete_versions(spark, path)
