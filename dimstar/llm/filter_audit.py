"""Filter interaction audit: what each of five filters removes in every order.

A document fails some of the filters A to E; only that set (a mask of five
bits) matters for any order. Documents are counted per (part, mask), and each
of these few cells is folded over the array of all 120 orders with
``transform`` and ``aggregate``: 600 structs, one per order and step, weighted
by the cell's counts. The cells of a part are merged by elementwise sums.

Filter E needs the whole table: a document fails it if a smaller id has the
identical text (equal SHA-256). Documents are counted per text, part, mask and
labels first, with the smallest id and how many rows have it, so a group of
copies is combined before it is shuffled and no pairs are formed.

Defined cases: a null or empty text has no words (it fails A only, and E if a
smaller id is empty too); a null source is the part with the empty name; a row
without an id fails E never and makes no other row fail it, and has no labels;
rows that repeat an id are documents of their own, none smaller than the
others; a document has quality or toxic 1 if any of its label rows says so; a
text of any length is counted whole; a table without documents gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow

REPEATED = "E"
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
SALTS = 1024
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_CONTINUATION = bytes(range(0x80, 0xC0))


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


# what fails each filter, from a text in UTF-8 and its words
FILTERS: dict[str, Callable[[bytes, list[bytes]], bool]] = {
    "A": lambda text, words: len(words) < 200,
    "B": lambda text, words: 100 * len(set(words)) < 50 * len(words),
    "C": lambda text, words: 100 * _count(text, _UPPER) > 2 * (len(text) - _count(text, _CONTINUATION)),
    "D": lambda text, words: _count(text, _MARKS) > 0,
}


def failures(docs: DataFrame, filters: Mapping[str, Callable] = FILTERS, id_col: str = "doc_id",
             text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask) of every row; bit i of the mask: the row fails the i-th filter."""
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    tests = list(filters.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, masks = [], []
            for cell in b.column(2).cast(pa.binary()):
                text = cell.as_py()
                words = text.split()  # at exactly the six ASCII white-space characters
                digests.append(hashlib.sha256(text).digest())
                masks.append(sum(1 << i for i, failed in enumerate(tests) if failed(text, words)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(digests, pa.binary()),
                                              pa.array(masks, pa.int32())], ["doc_id", "part", "digest", "mask"])

    return map_arrow(base, run, "doc_id bigint, part string, digest binary, mask int")


def mask_cells(failed: DataFrame, labels: DataFrame, repeated_bit: int) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and mask, with the bit
    of the table-wide filter set in the masks."""
    marked = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")).withColumn("no_salt", F.lit(0))
    # rows without an id match no label; the salt spreads them
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).otherwise(0)
    rows = (failed.withColumn("salt", salt)
            .join(marked, (F.col("doc_id") == F.col("labelled")) & (F.col("salt") == F.col("no_salt")), "left")
            .select("doc_id", "salt", "digest", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
                    F.coalesce("toxic", F.lit(0)).alias("toxic")))
    # same partitioning as the join: no further exchange
    per_id = rows.groupBy("doc_id", "salt", "digest", "part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))
    copies = per_id.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(named).alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    passing = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    told = copies.withColumn("first", first).select("part", "mask", "good", "toxic", "n", passing.alias("passing"))
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
                   F.struct(F.col("mask").bitwiseOR(F.lit(1 << repeated_bit)).alias("mask"),
                            (F.col("n") - F.col("passing")).alias("n")))
    return (told.select("part", "good", "toxic", F.inline(both)).filter("n > 0").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                 F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def _constant(value: list, kind: str) -> Column:
    """An array literal, folded once by the optimizer."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def folded(cells: DataFrame, letters: str) -> DataFrame:
    """Each cell with ``steps``: its weighted measures for every order and step, in one array."""
    one = {x: i for i, x in enumerate(letters)}
    all_orders = _constant([[1 << one[x] for x in o] for o in orders(letters)], "array<array<int>>")
    mask, n, zero = F.col("mask"), F.col("n"), F.lit(0).cast("bigint")
    weighted = lambda condition, weight: F.when(condition, weight).otherwise(zero)

    def step(before: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        left = before["left"] & ~fails
        out = F.struct(weighted(left, n).alias("kept"), weighted(before["left"] & fails, n).alias("removed"),
                       weighted(~before["left"] & fails, n).alias("redundant"),
                       weighted(mask == bit, n).alias("unique_fails"),
                       weighted(before["left"] & fails, F.col("good")).alias("good_lost"),
                       weighted(before["left"] & fails, F.col("toxic")).alias("toxic_lost"))
        return F.struct(left.alias("left"), F.concat(before["out"], F.array(out)).alias("out"))

    kind = "array<struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">>"
    start = F.struct(F.lit(True).alias("left"), F.array().cast(kind).alias("out"))
    fold = lambda order: F.aggregate(order, start, step, lambda end: end["out"])
    return cells.select("part", F.flatten(F.transform(all_orders, fold)).alias("steps"))


def merged(steps: DataFrame, letters: str) -> DataFrame:
    """Elementwise sums over the cells of each part (at most one per mask),
    one row per part, order and step, with the filters' Shapley sums."""
    size = len(letters)
    names = orders(letters)
    added = lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(
        *[(x[m] + y[m]).alias(m) for m in MEASURES]))
    total = steps.groupBy("part").agg(F.collect_list("steps").alias("cells")).select(
        "part", F.aggregate(F.slice("cells", 2, 1 << size), F.element_at("cells", 1), added).alias("steps"))
    rows = total.select("part", F.posexplode("steps").alias("at", "m"))
    order = F.element_at(_constant(names, "array<string>"), F.call_function("div", F.col("at"), F.lit(size)).cast("int") + 1)
    step = (F.col("at") % size + 1).cast("int")
    told = rows.select("part", order.alias("filter_order"), step.alias("step"), "m.*")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    # rows of a part are in one task already: 600 of them
    return told.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Callable] = FILTERS, id_col: str = "doc_id",
          text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for all orders of ``filters`` and E."""
    letters = "".join(filters) + REPEATED
    cells = mask_cells(failures(docs, filters, id_col, text_col, part_col), labels, len(filters))
    return merged(folded(cells, letters), letters)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, MIN(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
         100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text),
         regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > first, false)] AS fails
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cells AS (SELECT part, fails, COUNT(*) AS n, SUM(good) AS good, SUM(toxic) AS toxic FROM f GROUP BY ALL),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places FROM one a
      JOIN one b ON b.x <> a.x JOIN one c ON c.x NOT IN (a.x, b.x) JOIN one d ON d.x NOT IN (a.x, b.x, c.x)
      JOIN one e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, places, CAST(unnest([1, 2, 3, 4, 5]) AS INT) AS step FROM o),
r AS (SELECT part, filter_order, step, places[step] AS filter, n, good, toxic, fails[places[step]] AS failing,
        list_bool_or([fails[i] FOR i IN places[1:step - 1]]) AS gone, len([1 FOR i IN fails IF i]) = 1 AS alone
      FROM cells CROSS JOIN s),
t AS (SELECT part, filter_order, step, filter,
        SUM(CASE WHEN NOT coalesce(gone, false) AND NOT failing THEN n ELSE 0 END) AS kept,
        SUM(CASE WHEN NOT coalesce(gone, false) AND failing THEN n ELSE 0 END) AS removed,
        SUM(CASE WHEN coalesce(gone, false) AND failing THEN n ELSE 0 END) AS redundant,
        SUM(CASE WHEN failing AND alone THEN n ELSE 0 END) AS unique_fails,
        SUM(CASE WHEN NOT coalesce(gone, false) AND failing THEN good ELSE 0 END) AS good_lost,
        SUM(CASE WHEN NOT coalesce(gone, false) AND failing THEN toxic ELSE 0 END) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(SUM(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM t"""
