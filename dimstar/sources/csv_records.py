"""Records of CSV files whose quoted fields hold line ends, read by many tasks
per file.

A line maps the state it starts in (outside or inside a quoted field) to the
state it ends in. These maps compose, so each block of a file (one input split)
is reduced to its own map and the number of the line that began the record left
open at its end; a window over the blocks of a file (one narrow row each) gives
the state every block really starts in. A second scan then puts the lines of
each block together into records. Only a record that crosses a block border is
moved: its pieces are grouped by the block that it began in.

Quotes open a field at its start only, are doubled inside it, and are plain
characters elsewhere. If a quoted field is not closed until the end of its file,
the first line of its record is a record by itself, marked as torn, and so is
every line after it (not marked). Line ends are ``\\n`` or ``\\r\\n``; inside a quoted field
they are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# a line that starts outside quotes and ends inside; possessive, so its cost is linear
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
OPEN = f'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+)?+,)*+{_QUOTED}'


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, file, block``: the lines in the order of the file within each
    block; ``block`` is the block's first byte in the file."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def opens_quote(line: Column) -> Column:
    """The line, begun outside quotes, ends inside a quoted field."""
    return line.contains('"') & line.rlike(f"^{OPEN}$")


def has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """If no line by itself leaves a field open, every line is a record."""
    return not file_lines(spark, path).where(opens_quote(F.col("line"))).isEmpty()


def _line_reader():
    """``ends`` and ``states`` for whole arrays of lines. Made inside a function,
    so that they travel with the tasks: executors need not have this package."""
    inner = '[^"]*(?:""[^"]*)*'
    # each byte has one meaning, so no possessive quantifiers are needed: what
    # follows a closing quote does not start with a quote
    closed = '"(?:[^",][^,]*)?'
    opens = f'(?:(?:"{inner}{closed}|[^",][^,]*)?,)*"{inner}'
    from_outside, from_inside = f"^{opens}$", f"^{inner}(?:{closed},{opens})?$"

    def as_bytes(lines: pa.Array) -> pa.Array:
        return lines.view(pa.large_binary() if pa.types.is_large_string(lines.type) else pa.binary())

    def ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per line, the state it ends in if it starts outside, and inside."""
        return tuple(pc.match_substring_regex(lines, x).to_numpy(zero_copy_only=False).astype(np.int8)
                     for x in (from_outside, from_inside))

    def states(end0: np.ndarray, end1: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """The state before and after each line, the first of which starts in ``start``."""
        flips = np.cumsum(end0 > end1)
        last = np.maximum.accumulate(np.where(end0 == end1, np.arange(len(end0)), -1))
        known = last >= 0  # some line so far ends in the same state whatever it starts in
        after = np.where(known, end0[last] + flips - flips[last], start + flips) % 2
        return np.concatenate([[start], after[:-1]]), after

    def runs(*keys: np.ndarray) -> list[tuple[int, int]]:
        """First and last + 1 of each run of rows with equal keys."""
        new = np.zeros(len(keys[0]), dtype=bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        at = [0, *np.flatnonzero(new).tolist(), len(new)]
        return list(zip(at, at[1:], strict=False)) if len(new) else []

    return as_bytes, ends, states, runs


def _block_maps(lines: DataFrame) -> DataFrame:
    """Per block, for both states it may start in: the state at its end, and
    the number of its line that began the record left open (-1: none of its own)."""
    as_bytes, ends, states, runs = _line_reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, end, opener, found = None, 0, [0, 1], [-1, -1], []
        for b in batches:
            files, blocks = b.column(1).to_numpy(), b.column(2).to_numpy()
            end0, end1 = ends(as_bytes(b.column(0)))
            for i, j in runs(files, blocks):
                at = int(files[i]), int(blocks[i])
                if at != key:
                    if key is not None:
                        found.append((*key, *end, *opener))
                    key, n, end, opener = at, 0, [0, 1], [-1, -1]
                for start in (0, 1):
                    before, after = states(end0[i:j], end1[i:j], end[start])
                    # inside before and after: still the same record, whatever field it is
                    opened = np.flatnonzero(after > before)
                    end[start] = int(after[-1])
                    opener[start] = -1 if not end[start] else n + int(opened[-1]) if len(opened) else opener[start]
                n += j - i
        if key is not None:
            found.append((*key, *end, *opener))
        columns = list(zip(*found, strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                         ["file", "block", "end0", "end1", "opener0", "opener1"])

    return lines.mapInArrow(run, "file bigint, block bigint, end0 bigint, end1 bigint, opener0 bigint, opener1 bigint")


def block_states(lines: DataFrame) -> DataFrame:
    """``file, block, start, began, torn_block, torn_line``: whether the block
    starts inside a quoted field and the block in which that field's record
    began; and the line whose quote nothing in the file closes, if any. One
    narrow row per block."""
    maps = _block_maps(lines)
    order = Window.partitionBy("file").orderBy("block")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    constant, flips = F.col("end0") == F.col("end1"), F.col("end0") > F.col("end1")
    # the last block with one end for both starts, and the flips since
    counted = maps.withColumn("flips", F.sum(flips.cast("int")).over(upto))
    last = F.last(F.when(constant, F.struct("end0", "flips")), ignorenulls=True).over(before)
    state = counted.select("*", ((F.coalesce(last["end0"], F.lit(0)) + F.coalesce(F.lag("flips").over(order), F.lit(0))
                                  - F.coalesce(last["flips"], F.lit(0))) % 2).alias("start"))
    mine = state.select("file", "block", "start", F.when(F.col("start") == 1, F.col("end1")).otherwise(F.col("end0")).alias("end"),
                        F.when(F.col("start") == 1, F.col("opener1")).otherwise(F.col("opener0")).alias("opener"))
    opened = F.when((F.col("end") == 1) & (F.col("opener") >= 0), F.struct("block", "opener"))
    marked = mine.select("file", "block", "start", F.last(opened, ignorenulls=True).over(before).alias("open"),
                         F.last(opened, ignorenulls=True).over(upto).alias("newest"), "end",
                         F.row_number().over(Window.partitionBy("file").orderBy(F.desc("block"))).alias("from_end"))
    torn = marked.where("from_end = 1 and end = 1").select(F.col("file").alias("torn_file"), F.col("newest.block").alias("torn_block"),
                                                           F.col("newest.opener").alias("torn_line"))
    return (marked.join(torn, F.col("file") == F.col("torn_file"), "left")
            .select("file", "block", "start", F.col("open.block").alias("began"), "torn_block", "torn_line"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """``line, torn, header`` of every record: its text with the line ends
    inside, whether an unclosed quote tears it, and whether it is the first of
    its file."""
    lines = file_lines(spark, path)
    # one row of six numbers per input split: about 1e-6 of the input
    placed = lines.join(F.broadcast(block_states(lines)), ["file", "block"]).select(
        "line", "file", "block", "start", "began", "torn_block", "torn_line")
    # the pieces are few: a scan of their own moves them alone, and no record twice
    read = placed.mapInArrow(_assembled(pieces=False), "line string, torn boolean, header boolean")
    pieces = placed.mapInArrow(_assembled(pieces=True), "line string, header boolean, file bigint, began bigint, block bigint")
    # pieces of a record in several blocks: at most two per block
    whole = pieces.groupBy("file", "began").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line"))), lambda x: x["line"]), "\n").alias("line"),
        F.max("header").alias("header"))
    return read.unionByName(whole.select("line", F.lit(False).alias("torn"), "header"))


def _assembled(pieces: bool):
    """The records that lie within a block, or the pieces of those that do not."""
    as_bytes, ends, states, runs = _line_reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, held, inside, began, first, torn_at = None, 0, [], 0, None, False, None
        out, parts = [], []

        def joined(lines: pa.Array, at: np.ndarray) -> pa.Array:
            """Lines at[0] to at[1] - 1 as one text, and so on."""
            offsets = pa.array(at, pa.int32())
            return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), b"\n").cast(pa.binary())

        def put(texts: pa.Array, torn: bool = False) -> None:
            nonlocal first
            if len(texts) and not pieces:
                header = np.zeros(len(texts), dtype=bool)
                header[0] = first
                out.append((texts, pa.array(np.full(len(texts), torn)), pa.array(header)))
            first = first and not len(texts)

        def put_piece() -> None:
            nonlocal first
            if pieces:
                parts.append((b"\n".join(held), first, key[0], began, key[1]))
            first = False
            held.clear()

        def told() -> Iterator[pa.RecordBatch]:
            if pieces and parts:
                kinds = [pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*parts, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([columns[0].view(pa.string()), *columns[1:]],
                                                 ["line", "header", "file", "began", "block"])
            elif out:
                texts, torn, header = (pa.concat_arrays(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([texts.view(pa.string()), torn, header], ["line", "torn", "header"])
            out.clear()
            parts.clear()

        for b in batches:
            lines, files, blocks = as_bytes(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()
            end0, end1 = ends(lines)
            for i, j in runs(files, blocks):
                at = int(files[i]), int(blocks[i])
                if at != key:
                    if held:
                        put_piece()
                    inside, began, torn_block, torn_line = (b.column(c)[i].as_py() for c in range(3, 7))
                    key, n, first = at, 0, at[1] == 0
                    torn_at = None if torn_block is None else (torn_block, torn_line)
                # lines from the torn one on are records by themselves
                plain = j
                if torn_at is not None and key[1] >= torn_at[0]:
                    plain = i if key[1] > torn_at[0] else min(j, max(i, i + torn_at[1] - n))
                if plain > i:
                    before, after = states(end0[i:plain], end1[i:plain], inside)
                    inside = int(after[-1])
                    stops = np.concatenate([[i], np.flatnonzero(after == 0) + i + 1])
                    if before[0] and len(stops) > 1:  # the end of a record begun in an earlier batch or block
                        held.append(joined(lines, stops[:2])[0].as_py())
                        if began == key[1]:
                            put(pa.array([b"\n".join(held)], pa.binary()))
                            held.clear()
                        else:
                            put_piece()
                        stops = stops[1:]
                    if len(stops) > 1:
                        put(joined(lines, stops) if not pieces else lines.slice(i, len(stops) - 1))
                    if stops[-1] < plain:
                        if not before[stops[-1] - i]:
                            began = key[1]
                        held.append(joined(lines, np.array([stops[-1], plain]))[0].as_py())
                if plain < j:
                    marked = 1 if key[1] == torn_at[0] and n + plain - i == torn_at[1] else 0
                    put(joined(lines, np.arange(plain, plain + marked + 1)), torn=True)
                    put(joined(lines, np.arange(plain + marked, j + 1)))
                n += j - i
            yield from told()
        if held:
            put_piece()
        yield from told()

    return run
