"""Benchmark decontamination with spaced seeds, as DataFrame operations only.

Texts become tokens (lower case, letters and digits only). A mask such as
``111010011`` is laid at every token position and hashes the tokens under its
ones; the tokens under its zeros are ignored, so a substitution there does not
hide a copy. Hashes of benchmark items and documents are joined, and each hit
gives a diagonal (item start relative to the document) that is verified: the
overlap must hold a window of ``WINDOW`` tokens of the item (the whole item if
it is shorter) of which at least ``MIN_EQUAL`` are equal in place.

``MASKS`` are chosen so that any 13 tokens with two substitutions keep some
mask free of them. Where they do not suffice (items of fewer than 12 tokens,
another window or share), ``masks_for`` adds masks: spans, or the whole length
with gaps at the substitutions, down to a single token. So every overlap that
the verification accepts has a hit, and the result is the same as comparing
all alignments. Documents are hashed with an added mask only if the benchmark
has items that need it.

The benchmark side is counted and broadcast only under a bound; above it the
documents' keys are first looked up in a bitmap of the seeds of bounded size,
and those found are joined with a shuffle. An item and a document that repeat
one token have many diagonals; each is verified in time linear in the overlap. Documents are read twice: once for seeds,
once to verify the documents that have hits.

Defined cases: null and empty texts and items have no tokens and never match;
an item or document that repeats is reported once per (id, item id), at its best
place; rows whose id is null are not reported (and kept by
``drop_contaminated``); only the id and text columns are read.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sketch import in_sketch, key_sketch
from .common import materialise, shuffled, small_side, unused_name, without_ids

MASKS = ("1000011111", "111010011", "1110111")
WINDOW = 13
MIN_EQUAL = 0.8
SHORT_SPAN = 3  # tokens of a span that is short enough to be common
PATTERNS = 20_000  # sets of substitutions that are gone through one by one
_NOISE = r"[^\p{L}\p{N}\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Lower-case words without punctuation; words of punctuation only vanish."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), _NOISE, ""), _SPACE), lambda w: w != "")


def token_hashes(text: Column) -> Column:
    return F.coalesce(F.transform(tokens(text), lambda w: F.xxhash64(w)), F.array().cast("array<bigint>"))


def masks_for(n: int, min_equal: float = MIN_EQUAL, masks: tuple[str, ...] = MASKS) -> tuple[str, ...]:
    """The masks that, besides ``masks``, ``n`` tokens need so that each set
    of substitutions that ``min_equal`` allows leaves some mask free."""
    wrong = max(0, min(n - 1, n - math.ceil(n * min_equal)))
    least = n // (wrong + 1)  # some run of equal tokens is as long as this
    if math.comb(n, wrong) > PATTERNS:
        return ("1" * least,)

    def missed(used: tuple[str, ...]) -> list[tuple[int, ...]]:
        at = [{s + i for i, c in enumerate(m) if c == "1"} for m in used for s in range(n - len(m) + 1)]
        return [c for c in combinations(range(n), wrong) if not any(a.isdisjoint(c) for a in at)]

    left = missed(masks)
    if not left:
        return ()
    for span in range(n - wrong, max(least, SHORT_SPAN) - 1, -1):
        if not missed((*masks, "1" * span)):
            return ("1" * span,)
    return tuple(sorted({"".join("0" if i in c else "1" for i in range(n)).strip("0") for c in left}))


def _keys(h: Column, n: Column, number: int, mask: str) -> Column:
    """The mask's hash at every position where it fits."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    return F.when(n >= len(mask), F.transform(
        F.sequence(F.lit(1), n - (len(mask) - 1)),
        lambda i: F.xxhash64(F.lit(number), *[F.element_at(h, i + o) for o in at]),
    )).otherwise(F.array().cast("array<bigint>"))


def _key_here(number: int, mask: str) -> Column:
    """The same hash at place ``i`` of ``n``, from the columns ``h0``, ``h1``
    and so on of the tokens from there on; null where the mask does not fit."""
    return F.when(F.col("i") + (len(mask) - 1) <= F.col("n"),
                  F.xxhash64(F.lit(number), *[F.col(f"h{o}") for o, c in enumerate(mask) if c == "1"]))


def _seed(number: int):
    return lambda key, i: F.struct(key.alias("key"), i.alias("at"), F.lit(number).alias("mask"))


def _accepted(min_equal: float) -> Column:
    """One struct (equal) if the tokens ``a`` and ``b`` agree well enough in
    some window of ``need`` tokens, else none; linear in the overlap's length.

    A window may hold ``wrong`` differences, so it lies between two differences
    (or ends) with ``wrong`` others between them: such two must be more than
    ``need`` places apart."""
    length, need = F.col("length"), F.col("need")
    wrong = (need - F.ceil(need * F.lit(min_equal))).cast("int")
    differ = F.filter(F.sequence(F.lit(1), length), lambda i: F.element_at("a", i) != F.element_at("b", i))

    def judged(d: Column) -> Column:
        edges = F.concat(F.array(F.lit(0)), d, F.array(length + 1))
        apart = F.zip_with(edges, F.slice(edges, wrong + 2, F.size(edges)), lambda x, y: y - x)
        return F.struct((length - F.size(d)).alias("equal"), F.coalesce(F.array_max(apart) > need, F.lit(True)).alias("enough"))

    told = F.filter(F.transform(F.array(differ), judged), lambda r: r.getField("enough"))
    return F.transform(told, lambda r: F.struct(r.getField("equal").alias("equal")))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", masks: tuple[str, ...] = MASKS,
                 window: int = WINDOW, min_equal: float = MIN_EQUAL) -> DataFrame:
    """(doc_id, item_id, start, n_tokens, n_equal) of each document that holds
    a passage of an item: the best overlap's first token in the document, its
    length in tokens, and how many of these are equal."""
    items = materialise(
        benchmark.select(F.col(f"`{item_col}`").alias("item_id"),
                         token_hashes(F.col(f"`{item_text_col}`")).alias("item"))
        .filter(F.col("item_id").isNotNull() & (F.size("item") > 0)).distinct(),
        "decontam-items")
    size = F.size("item")
    needs = F.least(size, F.lit(window))
    lengths = sorted(r.n for r in items.select(needs.alias("n")).distinct().collect())  # ``window`` rows at most
    added: dict[str, list[int]] = {}
    for length in lengths:
        for mask in masks_for(length, min_equal, masks):
            added.setdefault(mask, []).append(length)
    everywhere, masks = len(masks), (*masks, *added)
    # an item is seeded with the added masks that its length needs
    lays = lambda m, mask: F.lit(True) if m < everywhere else needs.isin(added[mask])
    seeds = materialise(
        items.select("item_id", size.alias("n"), F.explode(F.concat(*[
            F.when(lays(m, mask), F.transform(_keys(F.col("item"), size, m, mask), _seed(m))).otherwise(
                F.expr("array()").cast("array<struct<key:bigint,at:int,mask:int>>"))
            for m, mask in enumerate(masks)])).alias("s"))
        .select("item_id", "s.*").distinct(), "decontam-seeds")

    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    read = texts.filter("doc_id IS NOT NULL")
    n = F.size("h")
    # one row per token, then one per mask that fits there: plain columns, which
    # Spark compiles, while a function over an array is interpreted per token.
    # The outer form: the plain one would add a filter that hashes the tokens a second time
    places = (read.select("doc_id", token_hashes(F.col("text")).alias("h"))
              .select("doc_id", "h", n.alias("n"), F.explode_outer(F.when(n > 0, F.sequence(F.lit(1), n))).alias("i"))
              .select("doc_id", "n", "i", *[F.get("h", F.col("i") + (o - 1)).alias(f"h{o}") for o in range(max(map(len, masks)))]))
    windows = (places.select("doc_id", "i", F.explode(F.array(*[_key_here(m, mask) for m, mask in enumerate(masks)])).alias("key"))
               .filter("key IS NOT NULL"))
    side = small_side(seeds)
    if side is seeds:  # too large to broadcast: most windows are dropped before the shuffle
        sketch = key_sketch(seeds, F.col("key"))
        windows = shuffled(in_sketch(windows, F.col("key"), sketch, "likely").filter("likely").drop("likely"))
    hits = materialise(
        windows.join(side, "key").select("doc_id", "item_id", (F.col("i") - 1 - F.col("at")).alias("diagonal"))
        .distinct(), "decontam-hits")

    hit_ids = materialise(hits.select("doc_id").distinct(), "decontam-hit-ids")
    again = read.join(small_side(hit_ids), "doc_id", "left_semi").select("doc_id", token_hashes(F.col("text")).alias("h"))
    first = F.greatest(F.col("diagonal"), F.lit(0))  # overlap in the document: [first, last)
    last = F.least(F.col("diagonal") + size, n)
    aligned = (again.join(small_side(hits), "doc_id").join(small_side(items), "item_id")
               .withColumn("need", F.least(F.lit(window), size))
               .withColumn("first", first).withColumn("length", last - first)
               .filter("length >= need")
               .select("doc_id", "item_id", "first", "length", "need",
                       F.slice("h", F.col("first") + 1, F.col("length")).alias("a"),
                       F.slice("item", F.col("first") - F.col("diagonal") + 1, F.col("length")).alias("b")))
    # a generator, since a filter would be pushed below and compute the alignment again
    found = aligned.select("doc_id", "item_id", "first", "length", F.inline(_accepted(min_equal)))
    top = F.max(F.struct("equal", "length", (-F.col("first")).alias("back"))).alias("t")
    return found.groupBy("doc_id", "item_id").agg(top).select(
        "doc_id", "item_id", (-F.col("t.back")).cast("bigint").alias("start"),
        F.col("t.length").cast("bigint").alias("n_tokens"), F.col("t.equal").cast("bigint").alias("n_equal"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **parameters) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage. Where a found id is
    on several rows, each of them is judged by its own text."""
    found = contaminated(docs, benchmark, id_col, text_col, **parameters)
    ids = materialise(found.select(F.col("doc_id").alias(id_col)).distinct(), "decontam-ids")
    clean = without_ids(docs, ids, id_col)
    several = materialise(docs.select(id_col).join(small_side(ids), id_col, "left_semi").groupBy(id_col).count()
                          .filter("count > 1").select(id_col), "decontam-several")
    if several.isEmpty():
        return clean
    row = unused_name(docs, "row")
    again = docs.join(small_side(several), id_col, "left_semi").withColumn(row, F.xxhash64(id_col, text_col))
    texts = again.select(F.col(row).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    bad = contaminated(texts, benchmark, **parameters).select(F.col("doc_id").alias(row)).distinct()
    return clean.unionByName(without_ids(again, materialise(bad, "decontam-rows"), row).drop(row))


# Any 13 aligned tokens with at most two substitutions hold four equal tokens
# in a row: four-token runs find all candidates here.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{N}\x20\x09-\x0D]+', '', 'g'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
b AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{L}\p{N}\x20\x09-\x0D]+', '', 'g'),
         '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
dg AS (SELECT doc_id, i, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d)),
bg AS (SELECT item_id, i, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS i FROM b)),
c AS (SELECT DISTINCT doc_id, item_id, dg.i - bg.i AS diagonal FROM dg JOIN bg USING (g)),
o AS (SELECT doc_id, item_id, d.w AS dw, b.w AS bw, diagonal, greatest(diagonal, 0) AS f,
             least(diagonal + len(b.w), len(d.w)) - greatest(diagonal, 0) AS n, least(13, len(b.w)) AS need
      FROM c JOIN d USING (doc_id) JOIN b USING (item_id)),
t AS (SELECT doc_id, item_id, diagonal, f, n, need, unnest(range(1, n + 1)) AS k, dw, bw FROM o WHERE n >= need),
e AS (SELECT doc_id, item_id, diagonal, f, n, need, k, CAST(dw[f + k] = bw[f - diagonal + k] AS INT) AS same FROM t),
s AS (SELECT *, sum(same) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY k) AS cum FROM e),
v AS (SELECT doc_id, item_id, diagonal, f, n, need, sum(same) AS equal,
             max(CASE WHEN k >= need THEN cum - coalesce(prior, 0) END) AS best
      FROM (SELECT x.*, y.cum AS prior FROM s x LEFT JOIN s y ON x.doc_id = y.doc_id AND x.item_id = y.item_id
            AND x.diagonal = y.diagonal AND y.k = x.k - x.need)
      GROUP BY doc_id, item_id, diagonal, f, n, need),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY equal DESC, n DESC, f) AS rn
      FROM v WHERE best >= ceil(need * 0.8))
SELECT doc_id, item_id, CAST(f AS BIGINT) AS start, CAST(n AS BIGINT) AS n_tokens, CAST(equal AS BIGINT) AS n_equal
FROM r WHERE rn = 1
"""
