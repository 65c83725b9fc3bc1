"""Token ids as raw binary shards, with a minimal perfect hash index.

``write`` encodes documents in ascending id order into shard files of raw
little-endian ids (two bytes each if the vocabulary fits, else four) without
any header, and builds an index: every (id, occurrence) has a slot with the
shard, the offset and the length of its ids, and a fingerprint that tells
keys which were never written.

The index is a Parquet table with one row per region; a region holds about
``REGION`` keys by their hash. Its minimal perfect hash is a cascade of bit
arrays: a key that is alone at its hashed bit stays in that level, the others
go on to the next; a key's slot is the number of set bits before its own. No
keys are stored. ``lookup`` finds the slots, ``read`` the ids.

Shards come from a range partitioning by id, so they are in global order and
any number of them can be written at once; a task that runs again replaces
its file by the same content. Regions are made by hash, so their sizes do not
depend on the ids.

Defined cases: a null text is an empty one and has the end id only; a null id
sorts first and is a key like any other; repeated ids share a shard (in the
order of their texts' hashes) and have occurrences 0, 1, ...; an empty table
writes no shard and an empty index; only the id and text columns are read.
"""

from __future__ import annotations

import binascii
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import scratch_path
from . import token_library
from .common import map_arrow, ship, small_side
from .files import Reader, Writer

END_ID = 1
REGION = 4096
LOAD = 2.0  # bits per key in each level
_INDEX = ("region bigint, n_keys bigint, level_bits array<bigint>, bits binary, fingerprint binary, "
          "shard binary, offset binary, length binary")


@dataclass(frozen=True)
class Output:
    """Where an output is: ``folder/data/shard-N.bin``, tables ``index`` and ``shards``."""
    folder: str
    id_bytes: int
    regions: int


# --- minimal perfect hash of one region, over pairs of 64-bit hashes ---

def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a + b * np.uint64(2 * level + 1) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_levels(a: np.ndarray, b: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits per level, and all levels' bits one after the other."""
    sizes, levels, left = [], [], np.arange(len(a))
    while len(left):
        n = max(1, int(LOAD * len(left)))
        at = (_mixed(a[left], b[left], len(sizes)) % np.uint64(n)).astype(np.int64)
        alone = np.bincount(at, minlength=n) == 1
        sizes.append(n)
        levels.append(alone)
        left = left[~alone[at]]
        if len(sizes) > 200:
            raise ValueError("two keys of a region have the same 128-bit hash")
    return sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool)


def slots(a: np.ndarray, b: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each key, -1 if no level has it."""
    rank = np.cumsum(bits) - bits
    out, left, start = np.full(len(a), -1, dtype=np.int64), np.arange(len(a)), 0
    for level, n in enumerate(sizes):
        at = start + (_mixed(a[left], b[left], level) % np.uint64(n)).astype(np.int64)
        hit = bits[at].astype(bool)
        out[left[hit]] = rank[at[hit]]
        left, start = left[~hit], start + n
    return out


def _hashed(keys: DataFrame, regions: int) -> DataFrame:
    """Adds region and the two hashes of (doc_id, occurrence)."""
    a = F.xxhash64("doc_id", "occurrence")
    return keys.select("*", F.pmod(a, F.lit(regions)).alias("region"), a.alias("a"),
                       F.xxhash64(F.lit(1), "occurrence", "doc_id").alias("b"))


def _fingerprint(b: np.ndarray) -> np.ndarray:
    return (b >> np.uint64(32)).astype("<u4")


def _build_region(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    a, b = (rows[c].to_numpy().astype(np.int64).view(np.uint64) for c in "ab")
    sizes, bits = build_levels(a, b)
    order = np.argsort(slots(a, b, sizes, bits))
    packed = {c: rows[c].to_numpy()[order].astype(kind).tobytes()
              for c, kind in (("shard", "<u4"), ("offset", "<u8"), ("length", "<u8"))}
    return pd.DataFrame([{"region": key[0], "n_keys": len(rows), "level_bits": sizes,
                          "bits": np.packbits(bits).tobytes(), "fingerprint": _fingerprint(b[order]).tobytes(), **packed}])


def _find_in_region(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(keys) or not len(index):
        return pd.DataFrame({c: [] for c in ("doc_id", "occurrence", "shard", "offset", "length")})
    r = index.iloc[0]
    a, b = (keys[c].to_numpy().astype(np.int64).view(np.uint64) for c in "ab")
    sizes = list(r.level_bits)
    bits = np.unpackbits(np.frombuffer(r.bits, np.uint8))[:sum(sizes)].astype(np.int64)
    at = slots(a, b, sizes, bits)
    known = at >= 0
    known[known] = np.frombuffer(r.fingerprint, "<u4")[at[known]] == _fingerprint(b[known])
    out, at = keys.loc[known, ["doc_id", "occurrence"]], at[known]
    return out.assign(shard=np.frombuffer(r["shard"], "<u4")[at].astype(np.int64),
                      offset=np.frombuffer(r["offset"], "<u8")[at].astype(np.int64),
                      length=np.frombuffer(r["length"], "<u8")[at].astype(np.int64))


# --- writing ---

def _shard_name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID,
          shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> Output:
    """Write ``docs`` under ``folder`` (a new one in the shared folder if
    None), in about ``shards`` files (the session's shuffle partitions)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    token_library.ship(spark, tokenizer)
    id_bytes = 2 if token_library.encoder(tokenizer).size <= 1 << 16 else 4
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
            .repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    places = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("occurrence", "shard", "offset", "length")])
    data = f"{folder}/data"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, out = token_library.encoder(tokenizer), TaskContext.get().partitionId(), None
        end = np.array([end_id], dtype=f"<u{id_bytes}").tobytes()
        offset, before, occurrence = 0, object(), 0
        for b in batches:
            out = out or Writer(data, _shard_name(shard))
            keys = b.column(0).to_pylist()
            occurrences, offsets, lengths = [], [], []
            for key, ids in zip(keys, enc.ids(token_library.texts_of(b.column(1).to_pylist())), strict=True):
                out.write(np.frombuffer(ids, "<u4").astype(f"<u{id_bytes}").tobytes() if id_bytes == 2 else ids)
                out.write(end)
                occurrence = occurrence + 1 if key == before else 0
                before, n = key, len(ids) // 4 + 1
                occurrences.append(occurrence)
                offsets.append(offset)
                lengths.append(n)
                offset += n
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (occurrences, [shard] * len(keys), offsets, lengths))],
                places.names)
        if out:
            out.close()

    map_arrow(rows, run, places).write.parquet(f"{folder}/places")
    written = spark.read.schema(places).parquet(f"{folder}/places")
    totals = written.groupBy("shard").agg(F.sum("length").alias("n_ids"))
    # one row per shard
    totals.select("shard", "n_ids", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("first_id")) \
        .write.parquet(f"{folder}/shards")
    regions = max(1, -(-written.count() // REGION))
    (_hashed(written, regions).groupBy("region").applyInPandas(_build_region, _INDEX).write.parquet(f"{folder}/index"))
    return Output(folder, id_bytes, regions)


# --- keyed access ---

def lookup(keys: DataFrame, output: Output) -> DataFrame:
    """(doc_id, occurrence, shard, offset, length) of those of the distinct
    ``keys`` (doc_id, occurrence) that the output has; offset and length
    count ids."""
    spark = keys.sparkSession
    ship(spark)
    asked = _hashed(keys.select("doc_id", "occurrence"), output.regions)
    schema = T.StructType([keys.schema["doc_id"], *(T.StructField(c, T.LongType())
                                                    for c in ("occurrence", "shard", "offset", "length"))])
    index = spark.read.schema(_INDEX).parquet(f"{output.folder}/index")

    def find(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        return _find_in_region(keys, index)

    return asked.groupBy("region").cogroup(index.groupBy("region")).applyInPandas(find, schema)


def read(places: DataFrame, output: Output) -> DataFrame:
    """``places`` with the raw ids of each (bytes of the output's width)."""
    shards = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = places.repartitionByRange(shards, "shard", "offset").sortWithinPartitions("shard", "offset")
    at, data, width = places.columns.index("shard"), f"{output.folder}/data", output.id_bytes
    start, size = places.columns.index("offset"), places.columns.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, file = None, None
        for b in batches:
            ids = []
            for s, o, n in zip(*(b.column(i).to_pylist() for i in (at, start, size)), strict=True):
                if s != shard:
                    if file:
                        file.close()
                    shard, file = s, Reader(data, _shard_name(s))
                ids.append(file.read(o * width, n * width))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], [*b.schema.names, "ids"])
        if file:
            file.close()

    return map_arrow(ordered, run, places.schema.add("ids", T.BinaryType()))


def read_back(spark: SparkSession, docs: DataFrame, output: Output, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of ``docs``, from the
    files: ``start`` counts all ids before the document."""
    keys = docs.groupBy(F.col(f"`{id_col}`").alias("doc_id")).count().select(
        "doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("count") - 1)).alias("occurrence"))
    first = spark.read.parquet(f"{output.folder}/shards").select("shard", "first_id")
    found = read(lookup(keys, output), output)
    width = output.id_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [binascii.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes())
                   for x in b.column(b.schema.names.index("ids")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(crc, pa.int64())],
                                             [*b.schema.names[:-1], "ids_crc32"])

    kept = T.StructType(found.schema.fields[:-1]).add("ids_crc32", T.LongType())
    return (map_arrow(found, run, kept).join(small_side(first), "shard")
            .select("doc_id", (F.col("first_id") + F.col("offset")).alias("start"),
                    F.col("length").alias("n_tokens"), "ids_crc32"))
