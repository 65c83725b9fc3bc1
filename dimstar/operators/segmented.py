"""Ordered per-group operations that stay correct and balanced when one group
holds a large share of all rows.

A plain ``Window.partitionBy(group)`` sends every row of a group to one task.
Groups of up to ``HOT_ROWS`` rows are left to it: one shuffle, nothing stored.
The rows of larger groups are range-partitioned on ``(group, order)`` instead, so a hot
group is cut into several *segments* (range partitions) of bounded size. The
window runs per ``(group, segment)``; the values that cross a segment border
come from a summary with one row per ``(group, segment)``, which is at most
``#groups + #segments`` rows, and whose per-group part is bounded by the
number of segments.

The segmented frame is stored (reliable storage named by
``spark.checkpoint.dir``): its segment ids are partition ids, which must not
change if a task is recomputed after an executor loss.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, stored

SEG = "_seg"
POS = "_pos"
HOT_ROWS = 2_000_000  # rows of a group that one task may order


def _cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _segments(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def segment(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
            num_segments: int | None = None, with_position: bool = False) -> DataFrame:
    """Range-partition on (group, order) and tag each row with its segment
    (and, with ``with_position``, a position increasing along the order)."""
    n = num_segments or _segments(df)
    keys = _cols([*group_cols, *order_cols])
    seg = (df.repartitionByRange(n, *keys)
           .sortWithinPartitions(*keys)
           .withColumn(SEG, F.spark_partition_id()))
    if with_position:
        seg = seg.withColumn(POS, F.monotonically_increasing_id())
    return stored(seg, "segments")


def _by_size(df: DataFrame, group_cols: Sequence[str], plain: Callable[[DataFrame], DataFrame],
             segmented: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``segmented`` for the rows of groups with more than ``HOT_ROWS`` rows,
    ``plain`` for the others. The sizes are counted in one job; there is at
    most one such group per ``HOT_ROWS`` rows."""
    hot = cut_lineage(df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
                      .select(*[F.col(c).alias(f"_hot{i}") for i, c in enumerate(group_cols)]))
    if hot.isEmpty():
        return plain(df)
    same = [F.col(c).eqNullSafe(F.col(f"_hot{i}")) for i, c in enumerate(group_cols)]
    return plain(df.join(F.broadcast(hot), same, "left_anti")).unionByName(
        segmented(df.join(F.broadcast(hot), same, "left_semi")))


def lead_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  value_col: str, out_col: str, has_next_col: str,
                  num_segments: int | None = None, segmented: bool = False) -> DataFrame:
    """``out_col`` = ``value_col`` of the next row of the group (NULL for the
    last row), ``has_next_col`` = whether a next row exists. ``order_cols``
    must be a total order inside the group. With ``segmented`` the input is
    already the output of :func:`segment` on the same columns, and keeps its
    segment columns."""
    if num_segments is None and not segmented:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return _by_size(
            df, group_cols,
            lambda x: x.withColumn(out_col, F.lead(value_col).over(w))
                       .withColumn(has_next_col, F.lead(F.lit(1)).over(w).isNotNull()),
            lambda x: lead_in_group(x, group_cols, order_cols, value_col, out_col, has_next_col, _segments(x)))
    seg = df if segmented else segment(df, group_cols, order_cols, num_segments)
    w = Window.partitionBy(*group_cols, SEG).orderBy(*order_cols)
    local = (seg.withColumn("_nx", F.lead(value_col).over(w))
                .withColumn("_hn", F.lead(F.lit(1)).over(w).isNotNull()))
    order_struct = F.struct(*_cols(order_cols))
    firsts = (seg.groupBy(*group_cols, SEG)
                 .agg(F.min_by(F.col(value_col), order_struct).alias("_first")))
    wseg = Window.partitionBy(*group_cols).orderBy(SEG)
    border = (firsts.withColumn("_bnx", F.lead("_first").over(wseg))
                    .withColumn("_bhn", F.lead(F.lit(1)).over(wseg).isNotNull())
                    .select(*group_cols, SEG, "_bnx", "_bhn"))
    joined = local.join(border, [*group_cols, SEG], "left")
    out = (joined
           .withColumn(out_col, F.when(F.col("_hn"), F.col("_nx")).otherwise(F.col("_bnx")))
           .withColumn(has_next_col, F.col("_hn") | F.coalesce(F.col("_bhn"), F.lit(False)))
           .drop("_nx", "_hn", "_bnx", "_bhn"))
    return out if segmented else out.drop(SEG)


def lag_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                 value_col: str, out_col: str, num_segments: int | None = None) -> DataFrame:
    """``out_col`` = ``value_col`` of the previous row of the group (NULL for
    the first row)."""
    if num_segments is None:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return _by_size(df, group_cols, lambda x: x.withColumn(out_col, F.lag(value_col).over(w)),
                        lambda x: lag_in_group(x, group_cols, order_cols, value_col, out_col, _segments(x)))
    seg = segment(df, group_cols, order_cols, num_segments)
    w = Window.partitionBy(*group_cols, SEG).orderBy(*order_cols)
    local = (seg.withColumn("_pv", F.lag(value_col).over(w))
                .withColumn("_hp", F.lag(F.lit(1)).over(w).isNotNull()))
    order_struct = F.struct(*_cols(order_cols))
    lasts = (seg.groupBy(*group_cols, SEG)
                .agg(F.max_by(F.col(value_col), order_struct).alias("_last")))
    wseg = Window.partitionBy(*group_cols).orderBy(SEG)
    border = (lasts.withColumn("_bpv", F.lag("_last").over(wseg))
                   .select(*group_cols, SEG, "_bpv"))
    joined = local.join(border, [*group_cols, SEG], "left")
    return (joined
            .withColumn(out_col, F.when(F.col("_hp"), F.col("_pv")).otherwise(F.col("_bpv")))
            .drop("_pv", "_hp", "_bpv", SEG))


def ffill_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   value_col: str, out_col: str, num_segments: int | None = None) -> DataFrame:
    """``out_col`` = last non-NULL ``value_col`` at or before the row within its
    group (forward fill), carried across segment borders."""
    if num_segments is None:
        w = (Window.partitionBy(*group_cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return _by_size(df, group_cols, lambda x: x.withColumn(out_col, F.last(value_col, ignorenulls=True).over(w)),
                        lambda x: ffill_in_group(x, group_cols, order_cols, value_col, out_col, _segments(x)))
    seg = segment(df, group_cols, order_cols, num_segments)
    w = (Window.partitionBy(*group_cols, SEG).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = seg.withColumn("_ff", F.last(value_col, ignorenulls=True).over(w))
    order_struct = F.struct(*_cols(order_cols))
    lasts = (seg.where(F.col(value_col).isNotNull())
                .groupBy(*group_cols, SEG)
                .agg(F.max_by(F.col(value_col), order_struct).alias("_last")))
    keys = seg.select(*group_cols, SEG).distinct()
    wseg = (Window.partitionBy(*group_cols).orderBy(SEG)
            .rowsBetween(Window.unboundedPreceding, -1))
    carry = (keys.join(lasts, [*group_cols, SEG], "left")
                 .withColumn("_carry", F.last("_last", ignorenulls=True).over(wseg))
                 .select(*group_cols, SEG, "_carry"))
    joined = local.join(carry, [*group_cols, SEG], "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("_ff"), F.col("_carry")))
                  .drop("_ff", "_carry", SEG))


def running_sum_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                         value_col: str, out_col: str, num_segments: int | None = None) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over the rows of the group up to this
    one and those that are level with it in the order, carried across segment
    borders. Level rows share a segment: they have the same range key."""
    if num_segments is None:
        w = (Window.partitionBy(*group_cols).orderBy(*order_cols)
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        return _by_size(df, group_cols, lambda x: x.withColumn(out_col, F.sum(value_col).over(w)),
                        lambda x: running_sum_in_group(x, group_cols, order_cols, value_col, out_col, _segments(x)))
    seg = segment(df, group_cols, order_cols, num_segments)
    w = (Window.partitionBy(*group_cols, SEG).orderBy(*order_cols)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = seg.withColumn("_rs", F.sum(value_col).over(w))
    totals = seg.groupBy(*group_cols, SEG).agg(F.sum(value_col).alias("_total"))
    wseg = (Window.partitionBy(*group_cols).orderBy(SEG)
            .rowsBetween(Window.unboundedPreceding, -1))
    carry = totals.withColumn("_carry", F.coalesce(F.sum("_total").over(wseg), F.lit(0))).drop("_total")
    return (local.join(carry, [*group_cols, SEG], "left")
                 .withColumn(out_col, F.col("_rs") + F.col("_carry"))
                 .drop("_rs", "_carry", SEG))
