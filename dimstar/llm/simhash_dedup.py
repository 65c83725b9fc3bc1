"""SimHash near-dedup with deletion-variant signatures.

A 64-bit fingerprint is cut into ``max_bits // 2 + 1`` segments (at least
two). Two fingerprints within ``max_bits`` differ by at most one bit in some
segment: if each of the first ``j`` segments differs by two bits or more, the
others share at most ``max_bits - 2 j`` of them. So segment ``j`` is indexed

* by all its one-wildcard variants (one bit removed at a time) while that
  budget is positive: equal or one-bit-apart segments share a variant;
* by its exact value when the budget is zero; not at all below.

Equal index keys are joined, and the Hamming distance of the whole
fingerprints is verified in the join condition. Only distinct fingerprints are
indexed, so exact copies never meet. Keys held by more than ``max_bucket``
fingerprints are not paired: their members are indexed by every removal of
``max_bits`` bits, where all members of one key are within ``max_bits`` of
each other, and each is linked to the smallest only. Either way every linked
pair ends up connected.

Links become components in ``components.py``. Defined cases: a null or empty
text, or one of white space only, has fingerprint zero and is linked like any
other; repeated rows each get a result row; a null ``doc_id`` keeps its row
and never is the smallest id of a component (a component with no other id
gets null); only the id and text columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, materialise, shuffled, small_side, unused_name, without_ids
from .components import connected_components

SEED = 42
SHINGLE = 3
MAX_BITS = 2
MAX_BUCKET = 256
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text. ASCII letters are lower-cased
    and words end at ASCII white space, which is what ``bytes`` methods do."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _BLOCK):  # a very long text is unpacked block by block
        part = hashes[i:i + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long) of each row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return map_arrow(rows, run, schema)


def _segments(max_bits: int) -> list[tuple[int, int, int]]:
    """(first bit, width, budget) of each segment."""
    n = max(2, max_bits // 2 + 1)
    cuts = [64 * j // n for j in range(n + 1)]
    return [(cuts[j], cuts[j + 1] - cuts[j], max_bits - 2 * j) for j in range(n)]


def variant_keys(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(slot, key, fp): the index entries of each fingerprint. ``slot`` is the
    wildcard's bit number, or 64 + the segment for an exact segment."""
    slots = []
    for j, (start, width, budget) in enumerate(_segments(max_bits)):
        mask = f"(shiftrightunsigned(-1L, {64 - width}))"
        seg = f"(shiftrightunsigned(fp, {start}) & {mask})"
        if budget > 0:
            slots.append(f"transform(sequence({start}, {start + width - 1}), i -> struct(i AS slot, "
                         f"{seg} & ~shiftleft(1L, i - {start}) AS seg))")
        elif budget == 0:
            slots.append(f"array(struct({64 + j} AS slot, {seg} AS seg))")
    e = fps.select("fp", F.explode(F.expr(f"concat({', '.join(slots)})")).alias("e"))
    # a segment has at most 32 bits, so slot and segment fit one long
    return e.select(F.expr("shiftleft(cast(e.slot AS bigint), 32) | e.seg").alias("key"), "fp")


def _first_key(max_bits: int) -> str:
    """True for one key of those a pair (a, b) shares: the wildcard at the
    differing bit, or a segment's first wildcard if the segments are equal."""
    tests = []
    x = "(a.fp ^ b.fp)"
    before = "true"
    for j, (start, width, budget) in enumerate(_segments(max_bits)):
        seg = f"(shiftrightunsigned({x}, {start}) & shiftrightunsigned(-1L, {64 - width}))"
        slot = "shiftrightunsigned(a.key, 32)"
        if budget > 0:
            tests.append(f"({before} AND (({seg} = 0 AND {slot} = {start}) OR "
                         f"(bit_count({seg}) = 1 AND {slot} BETWEEN {start} AND {start + width - 1} "
                         f"AND {seg} = shiftleft(1L, cast({slot} AS int) - {start}))))")
        elif budget == 0:
            tests.append(f"({before} AND {seg} = 0 AND {slot} = {64 + j})")
        before += f" AND bit_count({seg}) > 1"
    return "(" + " OR ".join(tests) + ")"


def removal_keys(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(m, rest, fp): each fingerprint without every choice of ``max_bits``
    bits; ``m`` holds those bits. One explode per bit, each above the last one:
    a plan with one expression per choice would not fit the driver."""
    found = fps.select("fp", F.expr("0L AS m"), F.expr("-1 AS top"))
    for k in range(max_bits):
        found = (found.select("fp", "m", F.explode(F.expr(f"sequence(top + 1, {64 - max_bits + k})")).alias("top"))
                 .select("fp", F.expr("m | shiftleft(1L, top) AS m"), "top"))
    return found.select("m", F.expr("fp & ~m AS rest"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(a, b) fingerprint pairs, a != b, all within ``max_bits``, that connect
    every pair of distinct fingerprints within ``max_bits``. ``fps`` has one
    row per distinct fingerprint."""
    keys = variant_keys(fps, max_bits)
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialise(shuffled(keys).join(shared, "key"), "simhash-members")
    small = shuffled(members.filter(F.col("n") <= max_bucket))
    pairs = (small.alias("a").join(small.alias("b"), F.expr(
        f"a.key = b.key AND a.fp < b.fp AND bit_count(a.fp ^ b.fp) <= {max_bits} AND {_first_key(max_bits)}"))
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
    crowded = members.filter(F.col("n") > max_bucket).select("fp").distinct()
    if crowded.isEmpty():
        return pairs
    # all of ``max_bits`` removals: members of one key are mutually within max_bits
    removals = materialise(removal_keys(crowded, max_bits), "simhash-removals")
    least = materialise(removals.groupBy("m", "rest").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").drop("n"), "simhash-least")
    stars = (shuffled(removals).join(least, ["m", "rest"]).filter("fp <> least")
             .select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct())
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) per row; ``component_id`` is the smallest id
    reachable over links of at most ``max_bits`` differing bits."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    return prints.join(_components(prints, max_bits, max_bucket), "fp").select("doc_id", "fp", "component_id")


def _components(prints: DataFrame, max_bits: int, max_bucket: int) -> DataFrame:
    """(fp, component_id, component) per fingerprint; ``component`` is one
    fingerprint of the component, the same for all of it."""
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    edges = links(classes.select("fp"), max_bits, max_bucket)
    # a node is ordered by its smallest id, so a component's root carries the answer;
    # classes without any id come last
    node = lambda side: F.struct(F.col(f"{side}.least").isNull().alias("none"),
                                 F.col(f"{side}.least").alias("least"), F.col(f"{side}.fp").alias("fp"))
    named = (edges.join(classes.alias("x"), F.col("a") == F.col("x.fp"))
             .join(classes.alias("y"), F.col("b") == F.col("y.fp"))
             .select(node("x").alias("u"), node("y").alias("v")))
    roots = connected_components(named).select(F.col("node.fp").alias("fp"), F.col("root.least").alias("root"),
                                               F.col("root.fp").alias("root_fp"))
    return materialise(
        classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "least").alias("component_id"),
                                                 F.coalesce("root_fp", "fp").alias("component")), "simhash-components")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row of each component: the one with its smallest id, of several rows
    with that id the one with the smallest fingerprint, then row hash. Rows
    without an id all stay. An id that several rows have decides nothing by
    itself: each of its rows is judged by its own text."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    parts = _components(prints, max_bits, max_bucket)
    found = materialise(prints.join(parts, "fp"), "simhash-found")
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_col))
    repeated = materialise(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias(id_col)).count()
                           .filter("count > 1").select(id_col), "simhash-repeated")
    if repeated.isEmpty():
        return without_ids(docs, materialise(gone, "simhash-gone"), id_col)
    single = without_ids(docs, materialise(gone.unionByName(repeated).distinct(), "simhash-gone"), id_col)
    row = unused_name(docs, "row")
    again = docs.join(small_side(repeated), id_col, "left_semi").withColumn(
        row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    own = fingerprints(again.withColumn(id_col, F.struct(F.col(f"`{id_col}`").alias("i"), F.col(row).alias("r"))),
                       id_col, text_col, shingle).join(parts, "fp")
    first = F.min(F.struct("fp", "doc_id.r")).getField("r").alias(row)
    kept = materialise(own.filter(F.col("doc_id.i") == F.col("component_id")).groupBy("component").agg(first)
                       .select(row).distinct(), "simhash-kept")
    return single.unionByName(again.join(small_side(kept), row, "left_semi").dropDuplicates([row]).drop(row))
