import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import documents, table_rows

from conftest import SF_SMALL
from dimstar.llm import byte_bpe as B
from dimstar.llm import queries as Q

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]
ALPHABET = "aabbcthe  \n\t'sredv  　 \x1c\x850١٢éñ中文ая😀-_.!AB́ǅªⅫ²"


def library(v):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


def noise(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


@pytest.mark.parametrize("file", FILES)
def test_same_ids_as_the_library(file):
    enc = B.encoder(P.path(file), P.PATTERN)
    lib, rng = library(enc.vocabulary), random.Random(0)
    texts = [noise(rng, rng.randrange(60)) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(32, 0x250)])) for _ in range(30))
              for _ in range(200)]
    texts += ["", "a" * 5000, " " * 3000 + "x", "ab" * 900, "<|endoftext|>", "\n" * 50]
    for t, ids in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t), repr(t)
        assert enc.decode(ids) == t.encode()


def test_cache_bound_keeps_results(monkeypatch):
    enc = B.Encoder(B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary)
    rng = random.Random(1)
    texts = [noise(rng, 50) for _ in range(200)]
    whole = enc.encode(texts)
    monkeypatch.setattr(B, "CACHE_ENTRIES", 10)
    small = B.Encoder(enc.vocabulary)
    assert [small.encode([t])[0] for t in texts] == whole


def test_every_prefix_has_the_library_encoding():
    v = B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary
    lib = library(v)
    table = B.PrefixTable(v)
    word = "internationalisierungen"
    for i, c in enumerate(word):  # exact appends
        table.append(c.encode())
        assert table.tokens() == lib.encode_ordinary(word[:i + 1])


def test_edits_recompute_only_near_entries():
    v = B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary
    rng = random.Random(2)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcethring") for _ in range(300))
        table = B.PrefixTable(v, piece)
        start = rng.randrange(200)
        stop = start + rng.randrange(4)
        until = table.replace(start, stop, b"the")
        fresh = B.PrefixTable(v, table.piece)
        assert (table.last, table.stop) == (fresh.last, fresh.stop) and until <= len(table.piece)
    table = B.PrefixTable(v, b"ab" * 2000)
    assert table.replace(100, 101, b"z") < 400


def test_text_edits():
    v = B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary
    lib, rng = library(v), random.Random(3)
    for _ in range(150):
        text = B.TokenizedText(v, noise(rng, 60))
        for _ in range(6):
            a = rng.randrange(len(text.text) + 1)
            text.replace(a, min(len(text.text), a + rng.randrange(6)), noise(rng, rng.randrange(8)))
            assert text.tokens() == lib.encode_ordinary(text.text)
        text.append(" and more")
        assert text.tokens() == lib.encode_ordinary(text.text)
    text = B.TokenizedText(v, "many plain words in a row " * 200)
    assert text.replace(2000, 2004, "xyz") < 10


def test_query_against_the_library(spark):
    v = B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary
    lib, expected = library(v), set()
    for d, t in table_rows(SF_SMALL, "documents", "doc_id, text"):
        ids = lib.encode_ordinary(t or "")
        expected.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                      hashlib.sha256((t or "").encode()).hexdigest()))
    got = Q.queries()["op6_byte_bpe"](spark, SF_SMALL)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == expected


def test_defined_cases(spark):
    texts = [(1, None), (1, ""), (2, "same"), (2, "same"), (None, "x y")]
    rows = B.encoded(documents(spark, texts, clash=True), P.path(FILES[0]), P.PATTERN).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids, r.decoded_sha256) for r in rows if r.doc_id == 1] == [(0, [], empty)] * 2
    assert len(rows) == 5 and len({r.ids_sha256 for r in rows if r.doc_id == 2}) == 1
    assert B.encoded(documents(spark, []), P.path(FILES[0]), P.PATTERN).count() == 0


def test_words_that_come_again_later_are_still_known():
    """300,000 different pieces, in two rounds: about those of 20 MB of text."""
    known = B.Recent(B.CACHE_ENTRIES)
    groups = [{f" {k}-{i}" for i in range(25_000)} for k in range(12)]
    for _ in range(2):
        left = 0
        for g in groups:
            new = known.missing(g)
            known.young.update(dict.fromkeys(new, b""))
            known.trim()
            left += len(new)
    assert left == 0


def test_the_trie_holds_each_token_once():
    v = B.encoder(P.path(FILES[0]), P.PATTERN).vocabulary
    found, open_ = {}, [(b"", v.trie)]
    while open_:
        head, follow = open_.pop()
        for byte, (token, more) in follow.items():
            word = head + bytes([byte])
            if token >= 0:
                found[word] = token
            open_.append((word, more))
    assert found == v.made
