"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

Of all tokenisations of a byte string, BPE's is the only one in which every
two neighbours would also be BPE's result for their joint bytes. So each
prefix of a string has exactly one valid last token: the token that ends there
and is compatible with the last token of the prefix before it. ``PrefixTable``
stores these; following them backwards gives the encoding. A prefix's entry
depends on nothing after it, so appending bytes only adds entries, and an edit
recomputes from the edited byte until the entries agree again with the old
ones. ``TokenizedText`` does the same for a whole text and its pieces.

On Spark, each task splits its texts into white-space chunks, keeps a bounded
cache of encoded chunks, and runs the tables for new ones only.

Defined cases: a null text is an empty one and has no ids; special strings are
ordinary text; repeated rows each get a result row; only the id and text
columns are read. The time of a piece grows linearly with its length, so very
long words and white-space runs are no special case.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

# Unicode White_Space, which is what \s means in the pattern
_WS = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
CACHE_ENTRIES = 300_000  # chunks, and pieces, of each generation
PAIR_ENTRIES = 250_000


class Vocabulary:
    """Ranks of a rank file, and how each token splits into its last merge."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, ranks), default=0)
        self.trie: dict[int, tuple[int, dict]] = {}  # byte -> (token that ends here or -1, what may follow)
        explicit = pattern.replace(r"[^\s", f"[^{_WS}").replace(r"\S", f"[^{_WS}]").replace(r"\s", f"[{_WS}]")
        self.pieces = regex.compile(explicit).findall
        self._pairs: dict[int, bool] = {}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.made: dict[bytes, int] = {}  # tokens that merging can make
        for rank in sorted(ranks.values()):
            token = self.bytes_of[rank]
            if len(token) == 1:
                self.made[token] = rank
                continue
            for cut in range(1, len(token)):
                a, b = self.made.get(token[:cut]), self.made.get(token[cut:])
                if a is not None and b is not None and self._check(a, b, rank):
                    self.left[rank], self.right[rank] = a, b
                    self.made[token] = rank
                    break
        follow, leaf = {b"": self.trie}, {}
        for token in sorted(self.made):
            for end in range(1, len(token) + 1):
                if token[:end] not in follow:
                    if follow[token[:end - 1]] is leaf:  # leaves share one dict until something follows
                        above = token[:end - 1]
                        follow[above] = {}
                        follow[above[:-1]][above[-1]] = (self.made.get(above, -1), follow[above])
                    follow[token[:end]] = leaf
                    follow[token[:end - 1]][token[end - 1]] = (self.made.get(token[:end], -1), leaf)

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            lines = f.read().split(b"\n")
        return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}, pattern)

    def _check(self, a: int, b: int, limit: float) -> bool:
        """Would BPE, with merges below ``limit``, end in a and b for their
        joint bytes? Merges are undone from the latest one; a merge across
        the border that would have come before an undone one refutes it."""
        ranks, name = self.ranks, self.bytes_of
        while True:
            across = ranks.get(name[a] + name[b])
            if across is not None and across < limit:
                return False
            last_a, last_b = (a if a in self.left else -1), (b if b in self.left else -1)
            if last_a < 0 and last_b < 0:
                return True
            if last_a > last_b:  # of equal merges the leftmost comes first
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    def compatible(self, a: int, b: int) -> bool:
        found = self._pairs.get(a << 20 | b)
        if found is None:
            if len(self._pairs) >= PAIR_ENTRIES:
                self._pairs.clear()
            found = self._pairs[a << 20 | b] = self._check(a, b, float("inf"))
        return found


class PrefixTable:
    """The valid last token of every prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary = vocabulary
        self.piece = b""
        self.last: list[int] = [-1]
        self.stop: list[int] = []  # per start, the byte at which no token goes on
        self.append(piece)

    def cut(self, length: int) -> None:
        """Forget all bytes from ``length`` on."""
        self.piece = self.piece[:length]
        del self.last[length + 1:], self.stop[length:]

    def append(self, more: bytes) -> None:
        known = len(self.piece)
        self.piece += more
        self.last += [-1] * len(more)
        self.stop += [len(self.piece)] * len(more)
        self._fill(known)

    def _fill(self, known: int, settled=None) -> None:
        """Compute the entries after the first ``known`` bytes: each token of
        the trie that starts where a valid last token ends is tried. An entry
        is final when its place is reached; ``settled(place)`` may end it."""
        piece, last, stop, n = self.piece, self.last, self.stop, len(self.piece)
        trie = self.vocabulary.trie
        pairs, compatible = self.vocabulary._pairs.get, self.vocabulary.compatible
        for start in range(max(0, known - self.vocabulary.longest + 1), n):
            if start < known:
                if stop[start] < known:  # its tokens ended among the known bytes
                    continue
            elif settled is not None and settled(start):
                return
            before, follow = last[start], trie
            stop[start] = n
            for end in range(start, n):
                found = follow.get(piece[end])
                if found is None:
                    stop[start] = end
                    break
                token, follow = found
                if token >= 0 and end >= known and last[end + 1] < 0:
                    if start:
                        fits = pairs(before << 20 | token)
                        if not (compatible(before, token) if fits is None else fits):
                            continue
                    last[end + 1] = token

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes start..stop; returns up to which
        byte entries were computed anew. Once as many entries as the longest
        token agree with the old ones, all later ones do."""
        old, ends, moved, until = self.last, self.stop, len(new) - (stop - start), [0]
        self.piece = self.piece[:start] + new + self.piece[stop:]
        self.last = old[:start + 1] + [-1] * (len(self.piece) - start)
        self.stop = ends[:start] + [len(self.piece)] * (len(self.piece) - start)

        def settled(place: int) -> bool:
            was = place - moved
            until[0] = until[0] + 1 if was > stop and old[was] == self.last[place] else 0
            if until[0] < self.vocabulary.longest:
                return False
            self.last[place:] = old[was:]
            self.stop[place:] = [e + moved for e in ends[was:]]
            until.append(place)
            return True

        self._fill(start, settled)
        return until[1] if len(until) > 1 else len(self.piece)

    def tokens(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.piece)  # a piece in the rank file is that token
        if whole is not None:
            return [whole]
        out, end = [], len(self.piece)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[self.last[end]])
        return out[::-1]


class TokenizedText:
    """A text with its pieces' tables, for appends and edits."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary = vocabulary
        self.text, self.pieces, self.tables = "", [], []
        self.append(text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """Replace characters start..stop; returns how many pieces were made anew."""
        moved = len(new) - (stop - start)
        text = self.text[:start] + new + self.text[stop:]
        ends = np.cumsum([len(p) for p in self.pieces], dtype=np.int64)
        # a piece is settled by its own characters and the two after it
        first = int(np.searchsorted(ends, start - 2, side="right"))
        at = int(ends[first - 1]) if first else 0
        borders = {int(e): i + 1 for i, e in enumerate(ends) if e >= stop}
        fresh, resume = [], len(self.pieces)
        for m in self.vocabulary.pieces.__self__.finditer(text, at):
            if m.start() - moved in borders and m.start() >= start + len(new):
                resume = borders[m.start() - moved]
                break
            fresh.append(m[0])
        tables = []
        for k, p in enumerate(fresh):
            data = p.encode()
            if not k and first < len(self.tables):  # the piece at the edit keeps what its old self shares
                table = self.tables[first]
                same = len(os.path.commonprefix([table.piece, data]))
                table.cut(same)
                table.append(data[same:])
            else:
                table = PrefixTable(self.vocabulary, data)
            tables.append(table)
        self.text = text
        self.pieces[first:resume], self.tables[first:resume] = fresh, tables
        return len(fresh)

    def tokens(self) -> list[int]:
        return [t for table in self.tables for t in table.tokens()]


class Recent:
    """A bounded cache in two generations: what is asked for again moves to the
    young one, and a full young generation takes the old one's place."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that are not here; the others become young."""
        rest = keys.difference(self.young)
        again = self.old.keys() & rest
        for k in again:
            self.young[k] = self.old.pop(k)
        return rest - again

    def trim(self) -> None:
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit integers) and back, with
    bounded caches of encoded chunks and of the pieces that chunks share."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.chunks, self.known_pieces = Recent(CACHE_ENTRIES), Recent(CACHE_ENTRIES)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [x for group in _groups(texts) for x in self._encode(group)]

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [_CHUNK.findall(t) for t in texts]
        new = self.chunks.missing(set().union(*split))
        pieces = {c: self.vocabulary.pieces(c) for c in new}
        several = self.known_pieces.missing(set().union(*pieces.values()))
        ids = self.known_pieces.young
        ids |= self._pieces(several)
        known = self.chunks.young
        for c, found in pieces.items():
            known[c] = ids[found[0]] if len(found) == 1 else b"".join([ids[p] for p in found])
        out = [b"".join([known[c] for c in x]) for x in split]
        self.chunks.trim()
        self.known_pieces.trim()
        return out

    def _pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """In sorted order a piece keeps the entries that it shares with the
        one before and appends the rest."""
        out, table, ranks = {}, PrefixTable(self.vocabulary), self.vocabulary.ranks
        for data in sorted(p.encode() for p in pieces):
            if data not in ranks:
                same, most = 0, min(len(data), len(table.piece))
                while same < most and data[same] == table.piece[same]:
                    same += 1
                table.cut(same)
                table.append(data[same:])
                ids = table.tokens()
            else:
                ids = [ranks[data]]
            out[data.decode()] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _groups(texts: list[str], size: int = 2_000_000) -> Iterator[list[str]]:
    """Texts in order, in groups of about ``size`` characters (one long text is a group)."""
    group, total = [], 0
    for t in texts:
        group.append(t)
        total += len(t)
        if total >= size:
            yield group
            group, total = [], 0
    if group:
        yield group


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker and rank file; a worker keeps it between tasks."""
    if (path, pattern) not in _ENCODERS:
        found = path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))
        _ENCODERS[path, pattern] = Encoder(Vocabulary.load(found, pattern))
    return _ENCODERS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, and ids as array<int>
    unless left out) per row. The ids are decoded again for the last digest."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            ids = enc.encode([t or "" for t in b.column(1).to_pylist()])
            n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            columns = [b.column(0), pa.array(n), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                       pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids], pa.string())]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    if not any(os.path.basename(path) in x for x in docs.sparkSession.sparkContext.listFiles):
        docs.sparkSession.sparkContext.addFile(path)  # for executors without the vocabulary files
    return map_arrow(rows, run, schema)
