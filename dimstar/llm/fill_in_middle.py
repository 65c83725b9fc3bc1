"""Fill-in-middle transformation over a learned index of token boundaries.

A text's tokens (a word with the white space before it, or white space at the
text's end) give its boundaries: rank k is the code-point offset after k
tokens. ``rank_index`` fits them by line segments: a segment predicts the
offset of each of its ranks within ``BOUND`` and the remaining difference is
one stored byte per rank. A segment that misses by more is halved until it
does not. ``offset_at`` reads a cut off that index: it predicts and adds the
residual, exactly and without looking at the text, so texts can be cut again
with any other seed.

Defined cases: a null text is an empty one (plain, no tokens); a text that
holds a marker stays plain; a null id hashes as the empty string; rows that
repeat an id are cut alike; a text is indexed whole, whatever its length, in
memory of a few times its size; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

BOUND = 127  # a residual fits one byte
SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_SCHEMA = ("doc_id bigint, text string, n bigint, "
           "segments array<struct<first:bigint,start:bigint,rise:bigint,run:bigint>>, residuals binary")


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8): all boundaries as
    code points from the text's start (0 and one after each token), and the
    number of them per text."""
    space = _SPACE[data]
    last = np.zeros(len(data), dtype=bool)  # bytes that end a token
    last[:-1] = ~space[:-1] & space[1:]
    filled = offsets[1:] > offsets[:-1]
    # a text's last byte ends a token, whatever follows in the next text
    last[offsets[1:][filled] - 1] = True
    at = np.flatnonzero(last) + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    text = np.searchsorted(offsets[1:], at, side="left")  # empty texts that end there come later
    n = np.bincount(text, minlength=len(offsets) - 1)
    out = np.zeros(len(at) + len(n), dtype=np.int64)
    first = np.cumsum(n + 1) - (n + 1)
    places = np.arange(len(at)) + text + 1
    out[places] = points[at] - points[offsets[:-1]][text]
    out[first] = 0
    return out, n + 1


def fit(values: np.ndarray, counts: np.ndarray, bound: int = BOUND) -> tuple[np.ndarray, ...]:
    """Segments (first position, start value, rise, run) over the concatenated
    ``values``, never across the groups of ``counts`` values, and the residual
    of each value. Within a segment, position i predicts
    ``start + rise * (i - first) // run``."""
    first, size = np.cumsum(counts) - counts, counts.astype(np.int64)
    residuals = np.zeros(len(values), dtype=np.int16)
    done: list[np.ndarray] = []
    while len(first):
        run = np.maximum(size - 1, 1)
        start, rise = values[first], values[first + size - 1] - values[first]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(first, size) + within
        miss = values[at] - np.repeat(start, size) - np.repeat(rise, size) * within // np.repeat(run, size)
        worst = np.maximum.reduceat(np.abs(miss), np.cumsum(size) - size)
        good = worst <= bound
        told = np.repeat(good, size)
        residuals[at[told]] = miss[told]
        done.append(np.stack([first[good], start[good], rise[good], run[good]]))
        first, size = first[~good], size[~good]
        half = size // 2
        first, size = np.concatenate([first, first + half]), np.concatenate([half, size - half])
    segments = np.concatenate(done, axis=1) if done else np.zeros((4, 0), dtype=np.int64)
    return *segments[:, np.argsort(segments[0], kind="stable")], residuals


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(1).cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        values, counts = boundaries(data, offsets)
        first, start, rise, run, residuals = fit(values, counts)
        base = np.cumsum(counts) - counts
        per_text = np.searchsorted(first, np.concatenate([base, [len(values)]]))
        owner = np.repeat(np.arange(len(counts)), np.diff(per_text))
        segments = pa.ListArray.from_arrays(
            pa.array(per_text, pa.int32()),
            pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (first - base[owner], start, rise, run)],
                                       ["first", "start", "rise", "run"]))
        stored = (residuals + BOUND).astype(np.uint8).tobytes()
        kept = pa.array([stored[s:s + n] for s, n in zip(base.tolist(), counts.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(counts - 1, pa.int64()), segments, kept],
            ["doc_id", "text", "n", "segments", "residuals"])


def rank_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n, segments, residuals) of every row."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return map_arrow(rows, _indexed, _SCHEMA)


def offset_at(rank: Column, segments: Column, residuals: Column) -> Column:
    """Code points before boundary ``rank``: the prediction of its segment and
    the stored residual."""
    s = F.element_at(F.filter(segments, lambda x: x["first"] <= rank), -1)
    predicted = s["start"] + F.call_function("div", s["rise"] * (rank - s["first"]), s["run"])
    stored = F.conv(F.hex(F.substring(residuals, rank.cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return predicted + stored - BOUND


def transformed(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, text, output) of every row."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("bigint")
    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (group(2) % 100 >= fim_percent)
    units = F.col("n") + 1
    drawn = (rank_index(docs, id_col, text_col).withColumn("h", hashed)
             .withColumn("form", F.when(plain, "plain").when(group(3) % 100 < spm_percent, "spm").otherwise("psm"))
             .withColumn("low", F.least(group(0) % units, group(1) % units))
             .withColumn("high", F.greatest(group(0) % units, group(1) % units)))
    cut = F.col("form") != "plain"
    at = lambda rank: F.when(cut, offset_at(F.col(rank), F.col("segments"), F.col("residuals")))
    placed = drawn.select("doc_id", "n", "form", "text", at("low").alias("p"), at("high").alias("m"))
    part = lambda start, length: F.substring(text, (start + 1).cast("int"), length.cast("int"))
    prefix, middle = part(F.lit(0), F.col("p")), part(F.col("p"), F.col("m") - F.col("p"))
    suffix = part(F.col("m"), F.length("text") - F.col("m"))
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
               .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
               .otherwise(text))
    return placed.select("doc_id", "n", "form", F.col("p").alias("prefix_chars"),
                         (F.col("m") - F.col("p")).alias("middle_chars"), "text", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone. No part holds a marker and
    no marker overlaps itself or another, so each is found where it was put."""
    size = len(MIDDLE)  # all markers
    a = F.when(form == "psm", F.instr(output, SUFFIX)).otherwise(F.instr(output, PREFIX))
    b = F.instr(output, MIDDLE)
    one = F.substring(output, F.lit(size + 1), a - size - 1)
    two = F.substring(output, a + size, b - a - size)
    three = F.substring(output, b + size, F.length(output))
    return (F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one))
            .otherwise(output))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT *, CAST(len(tokens) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(tokens[1:a], '') AS pre, array_to_string(tokens[a + 1:b], '') AS mid,
    array_to_string(tokens[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p"""
