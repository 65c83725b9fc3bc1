"""Statistics of whole texts that the quality operators judge by.

Words are runs without ASCII white space, lines are split at ``\\n``. A null
text has no words and no lines: every count is zero.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

WINDOW = 5
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_exclaim", "n_stops", "n_distinct", "n_adjacent", "n_short"]
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_CONTINUATION = bytes(range(0x80, 0xC0))
_LONG = 200_000


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that are found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    if len(words) > _LONG:  # word codes instead of tuples: bounded memory per word
        code: dict[bytes, int] = {}
        codes = np.fromiter((code.setdefault(w, len(code)) for w in words), dtype=np.int64, count=len(words))
        ranks = codes
        for k in range(1, window):
            ranks = np.unique(ranks[:-1] * len(code) + codes[k:], return_inverse=True)[1].astype(np.int64)
        repeated = np.bincount(ranks)[ranks] > 1
    else:
        grams = list(zip(*(words[i:] for i in range(window))))
        seen = Counter(grams)
        if len(seen) == n:
            return 0
        repeated = np.fromiter((seen[g] > 1 for g in grams), dtype=bool, count=n)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def counts(text: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one UTF-8 text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()  # bytes.split: exactly the six ASCII white-space characters
    seen: set[bytes] = set()
    n_dup = n_lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            n_lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    size = len(text)
    without = lambda chars: size - len(text.translate(None, chars))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return (len(words), len(text.translate(None, _SPACE + _CONTINUATION)), without(SYMBOLS), n_dup,
            repeated_words(words), n_lines, without(_UPPER), without(_DIGITS), text.count(b"!"),
            text.count(b"."), len(set(words)), sum(map(eq, words, words[1:])), int((lengths <= 3).sum()))


def with_counts(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` (whatever columns) as one struct column ``row``, followed by
    the counts of its column ``text_col`` as longs."""
    packed = rows.select(F.struct(*[rows[f"`{c}`"] for c in rows.columns]).alias("row"))
    schema = T.StructType([packed.schema["row"], *(T.StructField(c, T.LongType()) for c in COUNTS)])
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field(at).cast(pa.string()).cast(pa.binary())
            got = np.array([counts(t.as_py()) for t in texts], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(got[:, i]) for i in range(len(COUNTS)))], ["row", *COUNTS])

    return map_arrow(packed, run, schema)


def features() -> dict[str, Column]:
    """Scale-free statistics from the counts. The added ones keep the ratios
    of very short texts near the common range."""
    c = {n: F.col(n).cast("double") for n in COUNTS}
    per_word = lambda x: x / (c["n_words"] + 5.0)
    return {
        "symbols": per_word(c["n_symbols"]),
        "exclaim": per_word(c["n_exclaim"]),
        "adjacent": per_word(c["n_adjacent"]),
        "repeat": per_word(c["n_repeat_words"]),
        "short": per_word(c["n_short"]),
        "distinct": c["n_distinct"] / F.sqrt(c["n_words"] + 5.0),
        "stops": per_word(c["n_stops"]),
        "upper": c["n_upper"] / (c["word_chars"] + 25.0),
        "digits": c["n_digits"] / (c["word_chars"] + 25.0),
        "word_length": (c["word_chars"] + 25.0) / (c["n_words"] + 5.0),
        "dup_lines": c["n_dup_lines"] / (c["n_lines"] + 5.0),
        "line_words": F.log1p(c["n_words"] / (c["n_lines"] + 1.0)),
    }
