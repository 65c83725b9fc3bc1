"""Session helpers: a local session for tests and bench, and the checkpoint
folder used to cut lineage.

On a cluster the checkpoint folder is the shared one named by
``spark.checkpoint.dir``; we only pick a folder ourselves when none is set and
the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints that no frame refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = 8, app: str = "dimstar", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    Order: the folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf, then (local master only) a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster"
        )
    path = tempfile.mkdtemp(prefix="dimstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of an executor and a
    recomputation cannot change nondeterministic columns (partition ids)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_KEPT: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """Persist a frame that several parts of a result read, until the result
    it was made for is released (``kept_with``) or it is unpersisted by hand."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(df)
    return df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STORED: list[tuple] = []  # (Spark context, folder, weak reference to what every plan on the folder holds)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs that run in the block delete their shuffle files at their end; else
    these stay until the driver happens to collect its garbage. For jobs whose
    result is written or collected, not for frames that are run again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back, for frames that several parts of a result read. Unlike a
    persisted frame it holds no shuffle files (they are deleted when the table
    is written), its columns are compressed, readers read the columns they
    need, and no lost executor takes a part of it. The folder is deleted when
    no plan refers to it any more (``sweep``)."""
    spark = df.sparkSession
    sweep(spark)
    path = scratch_path(spark, name)
    with released_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    files = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    _STORED.append((spark.sparkContext, path, spark._jvm.java.lang.ref.WeakReference(files)))
    return table


def sweep(spark: SparkSession) -> None:
    """Delete the folders of stored frames that no plan refers to any more,
    frames derived from them included."""
    for entry in list(_STORED):
        sc, path, files = entry
        if sc._jsc is None or sc is not spark.sparkContext:  # a session that has ended
            _STORED.remove(entry)
        elif files.refersTo(None):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
            _STORED.remove(entry)


def _release(frames: list[DataFrame]) -> None:
    for df in frames:
        if df.sparkSession.sparkContext._jsc is not None:  # the session still runs
            df.unpersist(blocking=False)


def kept_with(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``build``, with the frames that it keeps released when nobody holds the
    result any more. Frames derived from the result stay right: they would
    compute a released frame again. Frames that it stores are deleted by a
    later build, when no derived frame is left either."""
    @wraps(build)
    def run(*args, **kwargs) -> DataFrame:
        start = len(_KEPT)
        spark = next((x for x in args if isinstance(x, SparkSession)), None)
        if spark is not None and _STORED:
            spark._jvm.System.gc()  # what former results stored goes now
            sweep(spark)
        try:
            result = build(*args, **kwargs)
        except BaseException:
            _release(_KEPT[start:])
            raise
        else:
            if _KEPT[start:]:
                weakref.finalize(result, _release, _KEPT[start:]).atexit = False
        finally:
            del _KEPT[start:]
        return result
    return run


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder, for
    intermediate tables that must outlive an executor."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings we run with on a large cluster, sized from the bytes read.

    Shuffle partitions start at one per ``target_partition_bytes`` of input
    (AQE coalesces small ones and splits skewed ones at run time); scans read
    large splits; broadcasts are decided from measured sizes only. The
    checkpoint folder must be set separately to shared storage
    (``spark.checkpoint.dir``)."""
    parts = max(200, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
