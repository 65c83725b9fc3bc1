"""Helpers shared by the training-data operators."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

BROADCAST_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors' Python
    first: they need not have it installed."""
    ship(df.sparkSession)

    def released(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(released, schema)


def ship(spark: SparkSession) -> None:
    """Once per session: this package for the executors' Python, and Arrow
    batches bounded by bytes (if the session sets no bound), since a fixed
    number of rows of long texts is no bound on memory."""
    if spark.conf.get(_BATCH_BYTES, None) in (None, "", "-1", "2147483647", "2147483647b"):
        spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    if getattr(spark.sparkContext, "_dimstar_shipped", False):
        return
    root, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = f"{scratch_path(spark, 'python')}/dimstar.zip"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(path)
    spark.sparkContext._dimstar_shipped = True


_MADE: list[str] = []


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage ends in files that outlive any executor, and later joins on
    the table get an exchange of their own, which AQE can split."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _MADE.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """At the end of the block, delete the tables that ``materialise`` made in
    it, apart from paths put into the yielded list. Results that read the
    others must be written by then."""
    start, keep = len(_MADE), []
    try:
        yield keep
    finally:
        for path in _MADE[start:]:
            if path not in keep:
                at = spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        del _MADE[start:]


def last_table() -> str:
    """Path of the table that ``materialise`` made last."""
    return _MADE[-1]


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values of a written table of plain columns and arrays of them."""
    def width(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if isinstance(field.dataType, T.ArrayType):
            return F.greatest(F.size(c), F.lit(0)) * 8
        return F.lit(8)

    row = F.lit(16).cast("bigint")
    for f in df.schema.fields:
        row = row + width(f)
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("n")).first().n


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (an already written table), with a broadcast hint when its
    measured bytes are at most ``most``; otherwise unchanged, so the join
    stays a shuffle join whose skewed partitions AQE splits."""
    return F.broadcast(df) if measured_bytes(df) <= most else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, with a hint that neither side of a join with it is broadcast.
    Spark takes a frame with an explode for as small as the frame below it, and
    a table for as small as its compressed files: what is made of a few MB and
    would pass through the driver can be hundreds."""
    return df.hint("merge")


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``ids`` (one column, same
    name). Rows with a null key are kept."""
    return docs.join(small_side(ids), key, "left_anti")


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column."""
    while name in df.columns:
        name += "_"
    return name


def hashed_share(keys: list, wanted: int, total: int):
    """Condition that holds for a share of the keys, by their hash, so that
    about ``wanted`` of ``total`` rows pass. Unlike an ordered limit it needs
    no task that sees the first rows of all others."""
    return F.pmod(F.xxhash64(F.lit("share"), *keys), F.lit(1 << 40)) < int((1 << 40) * min(1.0, wanted / max(1, total)))
