"""Range joins of times with intervals that may overlap in any way.

Time is cut into cells, and cells of 2, 4, 8, ... neighbours form a binary tree.
An interval is the union of at most two tree nodes per level, disjoint ones; a
time lies in one node per level. So "the interval holds the time" is an equality
of (group, level, node) for exactly one pair of rows, which Spark joins by hash
and AQE splits, however many rows a group has; no pairs of a group are formed
but the matching ones. The cells only find candidates: ends are compared as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .segmented import lead_in_group

LEVELS = 20  # 2**20 cells between the first start and the last probe


def _micros(df: DataFrame, name: str) -> Column:
    """Microseconds on a scale without gaps: a time without zone is not taken
    for one of the session's zone."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(c)
    c = c.cast("timestamp_ntz")
    seconds = F.datediff(c, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def _nodes(first: Column, last: Column, levels: int) -> Column:
    """Tree nodes (level, node) of the cells ``first`` to ``last``: per level the
    leftmost one if it is a right child, the rightmost one if it is a left child."""
    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        a = F.call_function("div", first + size - 1, size)
        b = F.call_function("div", last + 1, size) - 1
        left = F.when((a <= b) & (a % 2 == 1), F.struct(level.alias("level"), a.alias("node")))
        right = F.when((a <= b) & (b % 2 == 0), F.struct(level.alias("level"), b.alias("node")))
        return F.array(left, right)

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))
    return F.filter(every, lambda n: n.isNotNull())


def interval_join(probes: DataFrame, versions: DataFrame, probe_group: str, probe_ts: str, version_group: str,
                  valid_from: str = "valid_from", valid_to: str = "valid_to", levels: int = LEVELS) -> DataFrame:
    """F2 without a precondition: one row ``probe, version`` (structs of all
    columns) for every probe and every version of its group that holds its
    time: ``valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)``. NULL
    groups, times and starts match nothing.

    One small job reads the earliest start, the latest probe and the levels
    that intervals use."""
    p = probes.where(F.col(probe_group).isNotNull() & F.col(probe_ts).isNotNull()).select(
        F.struct(*[F.col(f"`{c}`") for c in probes.columns]).alias("probe"), F.col(probe_group).alias("_g"),
        _micros(probes, probe_ts).alias("_t"))
    v = versions.where(F.col(version_group).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("version"), F.col(version_group).alias("_vg"),
        _micros(versions, valid_from).alias("_from"), _micros(versions, valid_to).alias("_to"))
    ends = {r.end: r.t for r in p.agg(F.lit("hi").alias("end"), F.max("_t").alias("t")).unionByName(
        v.agg(F.lit("lo").alias("end"), F.min("_from").alias("t"))).collect()}
    # without a probe or a start, any span will do: nothing matches
    lo, hi = ends["lo"] or 0, ends["hi"] or 0
    cell = max(1, -(-(hi - lo + 1) // (1 << levels)))
    cell_of = lambda t: F.call_function("div", t - lo, F.lit(cell).cast("bigint"))
    end = F.least(F.coalesce("_to", F.lit(hi + 1)), F.lit(hi + 1)) - 1
    cut = (v.where((F.col("_from") <= hi) & (F.col("_to").isNull() | (F.col("_to") > F.col("_from"))))
           .select("version", "_vg", "_from", "_to",
                   F.inline(_nodes(cell_of(F.col("_from")), cell_of(end), levels)).alias("_level", "_node")))
    used = sorted(r["_level"] for r in cut.select("_level").distinct().collect())  # at most levels + 1 numbers
    placed = p.where(F.col("_t") >= lo).select(
        "probe", "_g", "_t", cell_of(F.col("_t")).alias("_c"), F.explode(F.array(*[F.lit(x) for x in used]).cast("array<int>")).alias("_l"))
    placed = placed.withColumn("_n", F.call_function("div", F.col("_c"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_l"))))
    holds = (F.col("_from") <= F.col("_t")) & (F.col("_to").isNull() | (F.col("_t") < F.col("_to")))
    return placed.join(cut, (F.col("_g") == F.col("_vg")) & (F.col("_l") == F.col("_level"))
                       & (F.col("_n") == F.col("_node")) & holds).select("probe", "version")


def overlapping(versions: DataFrame, group: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Groups with two versions that hold the same time (one column, ``group``).
    If any two overlap, two neighbours by start do, so the next start is enough;
    a group with very many versions is split into segments."""
    real = versions.where(F.col(group).isNotNull() & F.col(valid_from).isNotNull()
                          & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))))
    rows = real.select(F.col(group).alias("_g"), F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"))
    led = lead_in_group(rows, ["_g"], ["_from", "_to"], "_from", "_next", "_has_next")
    return led.where(F.col("_has_next") & (F.col("_to").isNull() | (F.col("_next") < F.col("_to")))) \
              .select(F.col("_g").alias(group)).distinct()
