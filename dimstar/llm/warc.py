"""WARC archives: written with revisit records, read by boundary chains.

Writing: payloads of ``MIN_REVISIT`` bytes or more that occur several times
are stored once, with the smallest id; the other records are revisits that
name it. Each task writes the rows it reads to one archive; page content is
not shuffled unless there are too many repeated payloads to broadcast their
digests.

Reading: an archive is cut into byte ranges. A task looks for the record magic
in its range, parses a candidate header at each, and emits (offset, offset of
its successor). Payloads may hold the magic and even whole headers, so a
candidate alone proves nothing: a record is real if the chain of successors
from offset 0 reaches it. Inside a range the task follows the chains itself
and emits where each leaves the range; between ranges, pointer jumping doubles
the reach each round, so the rounds grow with the logarithm of the ranges of a
file. From the first real record of each range, a second pass reads the
records one by one, streaming payloads in blocks.

A chain must end at the archive's last byte; otherwise reading fails and names
the archive. A response's digest is computed from its payload and must agree
with its header.

Defined cases: a null page is an empty payload, and payloads below
``MIN_REVISIT`` bytes are always responses; rows with the smallest id of a
payload are responses even if they repeat; a null id takes part like any other
but is never the smallest unless all are null; an empty table gives no
archives and no records; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import map_arrow, materialise, small_side
from .files import Reader, Writer, opened

MIN_REVISIT = 100
RANGE = 4 << 20
DATE = "1970-01-01T00:00:00Z"
MAGIC = b"WARC/1."
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HEAD = 64 << 10
_BLOCK = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """One WARC record. ``WARC-Payload-Length`` is an extension field: a
    revisit has no payload to measure."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    body = _HTTP if revisit else _HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', '', url or '')}",
             f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        lines += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages`` under ``folder`` (a new one in the shared folder if
    None). Returns the written archives: (folder, file, size)."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = materialise(
        rows.filter(F.octet_length("payload") >= min_revisit).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first"),
        "warc-first")
    # the payload's length is part of the condition: only payloads in ``first`` are long enough
    marked = rows.join(small_side(first), "digest", "left").select(
        F.col("id").cast("string").alias("id"), "url", "payload", "digest",
        (F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))).alias("revisit"),
        F.col("first").cast("string").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file = None, f"part-{TaskContext.get().partitionId():06d}.warc"
        for b in batches:
            for row in zip(*b.columns, strict=True):
                out = out or Writer(folder, file)
                out.write(record(*(x.as_py() for x in row)))
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([file]), pa.array([out.size])],
                                             ["folder", "file", "size"])

    return materialise(map_arrow(marked, run, "folder string, file string, size bigint"), "warc-files")


def _parse(head: bytes) -> tuple[dict[str, str], int] | None:
    """Fields and length of a record header at the start of ``head``."""
    if not _VERSION.match(head):
        return None
    end = head.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in head[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        key, colon, value = line.partition(":")
        if not colon:
            return None
        fields[key.strip().lower()] = value.strip()
    size = fields.get("content-length", "")
    if not size.isdecimal() or len(size.lstrip("0")) > 18:  # no file is that long
        return None
    return fields, end + 4


def _header(file: Reader, at: int, data: bytes = b"") -> tuple[dict[str, str], int] | None:
    """The header at ``at``, of any length; ``data`` is what is already known of the file from there."""
    block = _HEAD
    while not (found := _parse(data)):
        if _refused(data):
            return None
        more = file.read(at + len(data), block)
        if not more:
            return None
        data, block = data + more, 2 * block
    return found


def _refused(data: bytes) -> bool:
    """Whether ``data``, which does not parse, starts no header, whatever follows it."""
    if len(data) >= len(MAGIC) + 3 and not _VERSION.match(data):
        return True
    return b"\r\n\r\n" in data or any(b":" not in line for line in data.split(b"\r\n")[1:-1])


def candidates(file: Reader, start: int, stop: int) -> list[tuple[int, int]]:
    """(offset, successor) of everything in [start, stop) that parses as a
    record header and whose record ends inside the file."""
    data, found = file.read(start, stop - start + len(MAGIC) - 1), []
    at = data.find(MAGIC)
    while 0 <= at < stop - start:
        head = _header(file, start + at, data[at:at + _HEAD])
        after = start + at + head[1] + int(head[0]["content-length"]) + 4 if head else None
        if head and after <= file.size:
            found.append((start + at, after))
        at = data.find(MAGIC, at + 1)
    return found


def _ranges(archives: DataFrame, size: int) -> DataFrame:
    """(folder, file, size, start, stop) of every byte range, dealt evenly."""
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.filter("size > 0").select("*", F.explode(F.expr(
        f"sequence(0L, (size - 1) DIV {size})")).alias("k")).select(
        "folder", "file", "size", (F.col("k") * size).alias("start"),
        F.least((F.col("k") + 1) * size, "size").alias("stop")).repartition(n)


def chain_entries(archives: DataFrame, range_size: int = RANGE) -> DataFrame:
    """(folder, file, size, at): the places where the chain from offset 0
    enters a new range, 0 and the archive's end included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                file = Reader(row["folder"], row["file"])
                found = candidates(file, row["start"], row["stop"])
                file.close()
                leaves: dict[int, int] = {}
                for at, after in reversed(found):  # successors come later: their exits are known
                    leaves[at] = after if after >= row["stop"] else leaves.get(after, after)
                text, number = pa.string(), pa.int64()  # a range inside a payload may have no candidate at all
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["folder"]] * len(leaves), text), pa.array([row["file"]] * len(leaves), text),
                     pa.array(list(leaves), number), pa.array(list(leaves.values()), number)],
                    ["folder", "file", "at", "next"])

    key = ["folder", "file"]
    links = materialise(map_arrow(_ranges(archives, range_size), run,
                                  "folder string, file string, at bigint, next bigint"), "warc-links")
    # only places that some chain jumps to, and the starts, can be entries
    targets = links.select(*key, F.col("next").alias("at")).unionByName(
        archives.select(*key, F.lit(0).cast("bigint").alias("at"))).distinct()
    jumps = materialise(links.join(targets, [*key, "at"]), "warc-jumps")
    reached = archives.select(*key, F.lit(0).cast("bigint").alias("at"))
    while True:
        ahead = (reached.join(jumps, [*key, "at"]).select(*key, F.col("next").alias("at")))
        grown = materialise(reached.unionByName(ahead).distinct(), "warc-reached")
        if grown.count() == reached.count():
            break
        reached = grown
        onward = jumps.select(*key, F.col("at").alias("next"), F.col("next").alias("far"))
        jumps = materialise(jumps.join(onward, [*key, "next"], "left")
                            .select(*key, "at", F.coalesce("far", "next").alias("next")), "warc-jumps")
    return archives.join(reached, key)


def read(archives: DataFrame, range_size: int = RANGE, id_type: str = "bigint") -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to)
    of every record in the archives; fails if an archive is not one chain."""
    entries = materialise(chain_entries(archives, range_size), "warc-entries")
    broken = (entries.groupBy("folder", "file").agg(F.max((F.col("at") == F.col("size")).cast("int")).alias("whole"))
              .filter("whole = 0").select("file").limit(5).collect())
    if broken:
        raise ValueError(f"records do not lead to the end of {', '.join(sorted(r.file for r in broken))}")
    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = entries.filter("at < size").repartition(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                file, at = Reader(row["folder"], row["file"]), row["at"]
                stop, out = min(row["size"], (at // range_size + 1) * range_size), []
                while at < stop:
                    fields, start = _header(file, at)
                    size = int(fields["content-length"])
                    out.append(_answer(file, fields, at + start, size))
                    at += start + size + 4
                file.close()
                names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if k == "payload_bytes" else pa.string())
                     for k, c in zip(names, zip(*out, strict=True), strict=True)], names)

    found = map_arrow(starts, run, "page_id string, url string, record_type string, payload_bytes bigint, "
                                   "payload_digest string, refers_to string")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def _answer(file: Reader, fields: dict[str, str], at: int, size: int) -> tuple:
    name = lambda field: fields.get(field, "")[len("<urn:page:"):-1] or None
    told = fields["warc-payload-digest"].removeprefix("sha256:")
    kind, n = fields["warc-type"], int(fields["warc-payload-length"])
    if kind == "response":
        seen, first, n = hashlib.sha256(), True, 0
        for start in range(at, at + size, _BLOCK):
            data = file.read(start, min(_BLOCK, at + size - start))
            if first:  # the block starts with the HTTP header
                data, first = data[data.index(b"\r\n\r\n") + 4:], False
            seen.update(data)
            n += len(data)
        if seen.hexdigest() != told:
            raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
    return name("warc-record-id"), fields.get("warc-target-uri"), kind, n, told, name("warc-refers-to")


def archive_list(spark: SparkSession, folder: str) -> DataFrame:
    """(folder, file, size) of the archives in a folder."""
    from pyarrow import fs

    system, path = opened(folder)
    found = [i for i in system.get_file_info(fs.FileSelector(path)) if i.base_name.endswith(".warc")]
    schema = T.StructType([T.StructField("folder", T.StringType()), T.StructField("file", T.StringType()),
                           T.StructField("size", T.LongType())])
    return spark.createDataFrame([(folder, i.base_name, i.size) for i in found], schema)


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""
