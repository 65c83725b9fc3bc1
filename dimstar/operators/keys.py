"""Dense surrogate keys 1..N in a given order without a single-partition sort.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead: range-partition and sort on the order, number rows inside each
partition, and add the row count of all earlier partitions. The per-partition
count table has one row per partition (bounded by the partition count), so it
is broadcast safely.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segmented import POS, SEG, segment


def dense_keys(df: DataFrame, order_cols: Sequence[Column | str], key_name: str,
               num_partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = 1..N following ``order_cols`` (a total order)."""
    seg = segment(df, [], order_cols, num_partitions, with_position=True)
    return number_segments(seg, key_name)


def number_segments(seg: DataFrame, key_name: str) -> DataFrame:
    """Dense 1..N over a frame produced by ``segment(..., with_position=True)``
    (stored, so segment ids and positions are fixed). The
    offset table has one row per segment."""
    before = Window.orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (seg.groupBy(SEG)
                  .agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
                  .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                  .select(SEG, "_off", "_first"))
    return (seg.join(F.broadcast(offsets), SEG)
               .withColumn(key_name, (F.col("_off") + F.col(POS) - F.col("_first") + 1).cast("bigint"))
               .drop(SEG, POS, "_off", "_first"))
