"""Token ids as the tokenizers and sentencepiece libraries give them.

``Encoder.ids(texts)`` returns what the library returns for each whole text,
without added special tokens, truncation or padding. If the tokenizer's own
definition drops white space between its pieces, a text's ids are those of its
words one after the other; then each distinct word is given to the library
once and kept in a bounded cache. Otherwise whole texts are given to it.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from importlib.metadata import version

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

CACHE_ENTRIES = 750_000
LONG_WORD = 200
_TAIL = b".,!?;:|*%&$#"  # ASCII punctuation that forms a piece of its own after a letter or digit
_SPACES = " \t\n\r\x0b\x0c"  # where bytes.split() splits


def splits_at_spaces(definition: dict) -> bool:
    """True if no piece or added token can hold ASCII white space, and it is
    dropped: the normaliser makes every white-space run one
    space, and the pre-tokenizer keeps only matches of a pattern that has
    white space in no class but negated ones."""
    steps = definition.get("normalizer") or {}
    steps = steps.get("normalizers", [steps])
    joined = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " "
                 for s in steps)
    if not joined or any(s.get("type") not in ("NFC", "Replace", "Lowercase") for s in steps):
        return False
    pre = definition.get("pre_tokenizer") or {}
    pre = pre.get("pretokenizers", [pre])
    if not pre or pre[0].get("type") != "Split" or pre[0].get("behavior") != "Removed" or not pre[0].get("invert"):
        return False
    pattern = pre[0].get("pattern", {}).get("Regex", " ")
    if re.search(r"\\s|\\S|\\W|\\P|\.| ", re.sub(r"\[\^\\s[^\]]*\]", "", pattern)):
        return False
    if any(p.get("type") != "ByteLevel" or p.get("add_prefix_space") or p.get("use_regex") for p in pre[1:]):
        return False
    return all(not t["lstrip"] and not t["rstrip"] and not t["normalized"] and not set(t["content"]) & set(_SPACES)
               for t in definition.get("added_tokens", []))


class Encoder:
    def __init__(self, path: str):
        self.words: dict[bytes, bytes] = {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._library = lambda texts: [np.array(x, dtype="<u4").tobytes()
                                           for x in model.encode(texts, num_threads=1)]
            self.size, self.by_word = model.get_piece_size(), False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._library = lambda texts: [np.array(x.ids, dtype="<u4").tobytes()
                                       for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            self.by_word = splits_at_spaces(json.load(f))

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= 4_000_000:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._library([t.decode() for t in texts]) if texts else []
        collects = gc.isenabled()
        gc.disable()  # nothing here makes cycles; collections would walk the cache again and again
        try:
            return self._by_word(texts)
        finally:
            if collects:
                gc.enable()

    def _by_word(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        asked = set().union(*split)
        if len(self.words) > CACHE_ENTRIES:
            self.words = {w: self.words[w] for w in asked.intersection(self.words)}
        known = self.words
        new = asked.difference(known)
        self._learn(new)
        get = known.__getitem__
        out = [b"".join(map(get, x)) for x in split]
        for w in new:
            if len(w) > LONG_WORD:
                del known[w]
        return out

    def _learn(self, new: set[bytes]) -> None:
        """A word that ends in a letter or digit and punctuation is two pieces
        or more that meet there: both sides are looked up on their own."""
        known, cut, alone = self.words, [], set()
        for w in new:
            core = w.rstrip(_TAIL)
            if core and core != w and _ends_a_piece(core):
                cut.append((w, core))
                alone.add(core)
                alone.add(w[len(core):])
            else:
                alone.add(w)
        alone.difference_update(known)
        letters = [w for w in alone if w.isalpha() or w.decode().isalpha()]
        for i in range(0, len(letters), 2000):
            self._learn_letters(letters[i:i + 2000])
        rest = [w for w in alone if w not in known]
        known.update(zip(rest, self._library([w.decode() for w in rest]), strict=True))
        for w, core in cut:
            known[w] = known[core] + known[w[len(core):]]
        for w in alone - new:
            if len(w) > LONG_WORD:
                known.pop(w, None)

    def _learn_letters(self, words: list[bytes]) -> None:
        """Words of letters are one piece each: one text of many words saves
        calls. If the pieces are not as many as the words, they are left to
        the caller, one by one."""
        found = self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False)
        piece = np.array(found.word_ids, dtype=np.float64)
        if not len(piece) or np.isnan(piece).any() or piece[-1] + 1 != len(words):
            return
        starts = np.searchsorted(piece, np.arange(len(words) + 1))
        if (np.diff(piece) < 0).any() or (np.diff(starts) < 1).any():
            return
        data, cuts = np.array(found.ids, dtype="<u4").tobytes(), (4 * starts).tolist()
        self.words.update(zip(words, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))


def _ends_a_piece(core: bytes) -> bool:
    """The last character, lower-cased, is a letter or digit (U+0130 becomes
    a letter and a mark that would join the punctuation)."""
    if core[-1] < 128:
        return core[-1:].isalnum()
    return core[-4:].decode(errors="ignore")[-1:].lower().isalnum()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker and file; a worker keeps it between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    return _ENCODERS[path]


def ship(spark: SparkSession, path: str) -> None:
    """Send the tokenizer's file to executors that do not have it."""
    if not any(os.path.basename(path) in x for x in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)


def digest(path: str) -> str:
    """Identifies what counts depend on: the file and the library's version."""
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        return hashlib.sha256(f"{name} {version(name)} ".encode() + f.read()).hexdigest()


def texts_of(column: Iterable) -> list[bytes]:
    return [t.encode() if isinstance(t, str) else t or b"" for t in column]
