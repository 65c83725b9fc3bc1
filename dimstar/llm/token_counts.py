"""Token counts through a digest cache.

The cache is a Parquet table of (tokenizer, digest, n_tokens): ``tokenizer``
identifies the vocabulary file and the library version, ``digest`` the
normalised content. Normalising may only merge texts that have the same count:
white-space runs become one space if the tokenizer drops white space, else
texts are taken as they are. Documents are joined to the cache by digest; of
the digests that it lacks, one text each is encoded and its count appended.

Copies are reduced inside each task before the shuffle, so a text that makes
up a third of all rows arrives once per task. With a cache that has counts,
digests are joined before contents move. The counts of all rows then come
from the cache alone, by a join of narrow rows that AQE can split.

One writer at a time should append to a cache; a digest that two of them
append has the same count twice and is read once. A job that is lost before its
append is committed leaves the cache as it was.

Defined cases: a null text is an empty one (no bytes, no tokens); repeated
rows each get a result row; only the id and text columns are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sketch import hashed, in_sketch, key_sketch
from ..session import scratch_path
from . import token_library
from .common import map_arrow, materialise, small_side

LIMIT = 2048
SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


def normaliser(path: str):
    """Column -> Column of text with the same count, alike for more texts."""
    by_word = False
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            by_word = token_library.splits_at_spaces(json.load(f))

    def normalised(text: Column) -> Column:
        text = F.coalesce(text.cast("string"), F.lit(""))
        return F.trim(F.regexp_replace(text, "[ \t\n\r]+", " ")) if by_word else text

    return normalised


def read_cache(spark, cache: str) -> DataFrame:
    """The table at ``cache``, empty if nothing has been written there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        spark.createDataFrame([], SCHEMA).write.parquet(cache)
    return spark.read.schema(SCHEMA).parquet(cache)


def encode_misses(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of the distinct (digest, content) rows."""
    token_library.ship(texts.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = token_library.encoder(path)
        for b in batches:
            counts = [len(x) // 4 for x in enc.ids(token_library.texts_of(b.column(1).to_pylist()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return map_arrow(texts, run, "digest binary, n_tokens bigint")


def missing(texts: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of (digest, content) whose digest may be missing from ``known``:
    digests alone are joined first, so a content that is counted already is not
    shuffled. Where too many are missing for a broadcast, a bitmap of bounded
    size stands in for them, and a few known rows come along."""
    digests = materialise(texts.select("digest").distinct().join(known.select("digest"), "digest", "left_anti"), "count-misses")
    side = small_side(digests)
    if side is not digests:
        return texts.join(side, "digest", "left_semi")
    return in_sketch(texts, hashed("digest"), key_sketch(digests, hashed("digest")), "likely").filter("likely").drop("likely")


def counted(docs: DataFrame, path: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text",
            limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row. ``cache`` is a folder
    that later calls can use again; a new one in the shared folder if None."""
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-counts")
    name = token_library.digest(path)
    content = normaliser(path)(F.col(f"`{text_col}`"))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    known = read_cache(spark, cache).filter(F.col("tokenizer") == name)
    texts = docs.select(digest.alias("digest"), content.alias("content"))
    if not known.isEmpty():
        texts = missing(texts, known)
    misses = texts.dropDuplicates(["digest"]).join(known.select("digest"), "digest", "left_anti")
    (encode_misses(misses, path).select(F.lit(name).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), digest.alias("digest"),
                       F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0))
                       .cast("bigint").alias("n_bytes"))
    counts = read_cache(spark, cache).filter(F.col("tokenizer") == name).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens",
                                              (F.col("n_tokens") > limit).alias("over_limit"))
