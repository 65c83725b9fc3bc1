import binascii
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from helpers import documents, table_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from dimstar.llm import queries as Q
from dimstar.llm import token_counts as N
from dimstar.llm import token_library as L
from dimstar.llm import token_output as O
from dimstar.session import scratch_path

FILE = P.path("word_bpe_49k.json")


def library(texts):
    return [e.ids for e in Tokenizer.from_file(FILE).encode_batch(texts, add_special_tokens=False)]


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_word_cache_gives_the_library_ids(monkeypatch):
    rng = random.Random(5)
    alphabet = "aAbB's't  \n\t\r　é́İΣςÀ中ㄱ각가.,!|*0١²Ⅻǆﬁ\x1c\x85\xa0\x0b\x0c "
    texts = ["".join(rng.choice(alphabet) if rng.random() < .8 else
                     rng.choice(["<|endoftext|>", "word", "don't", "x<|startoftext|>.", "<|endoftext|>,"])
                     for _ in range(rng.randrange(40))) for _ in range(2500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0xD7FF), rng.randrange(32, 0x250), 32])) for _ in range(30))
              for _ in range(500)] + ["", "x" * 5000, "a. " * 3000]
    enc = L.Encoder(FILE)
    assert enc.by_word and list(enc.ids(L.texts_of(texts))) == [as_bytes(x) for x in library(texts)]
    monkeypatch.setattr(L, "CACHE_ENTRIES", 50)
    assert list(L.Encoder(FILE).ids(L.texts_of(texts[:300]))) == [as_bytes(x) for x in library(texts[:300])]
    assert not L.Encoder(P.path("byte_bpe_50k.json")).by_word


# --- binary output ---

def test_output_query(spark):
    rows = sorted(table_rows(SF_SMALL, "documents", "doc_id, text"))
    expected, start = set(), 0
    for (d, _), ids in zip(rows, library([t or "" for _, t in rows]), strict=True):
        expected.add((d, start, len(ids) + 1, zlib.crc32(as_bytes([*ids, 1]))))
        start += len(ids) + 1
    got = Q.queries()["op7_token_output"](spark, SF_SMALL)
    assert {tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == expected


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for _ in range(2))
    sizes, bits = O.build_levels(a, b)
    assert sorted(O.slots(a, b, sizes, bits)) == list(range(n))
    assert sum(sizes) <= 8 * n + 8
    with pytest.raises(ValueError):
        O.build_levels(np.repeat(a[:1], 2), np.repeat(b[:1], 2)) if n else O.build_levels(*[np.zeros(2, np.uint64)] * 2)


def test_keyed_access_and_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(O, "REGION", 8)
    rng = random.Random(0)
    texts = [(i, " ".join(rng.choices(["alpha", "beta", "gamma", "delta."], k=rng.randrange(30)))) for i in range(100, 200)]
    texts += [(150, "again"), (150, "again"), (7, None), (7, ""), (None, "no id"), (None, "no id"), (3, "word " * 30_000)]
    out = O.write(documents(spark, texts, clash=True), FILE)
    read = spark.read.parquet(f"{out.folder}/index")
    assert out.regions > 10 and read.agg(F.sum("n_keys")).first()[0] == len(texts)
    back = O.read_back(spark, documents(spark, texts), out).orderBy("start").collect()
    by_id = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in back] == [d for d, _ in by_id]
    assert [r.start for r in back] == list(np.cumsum([0] + [r.n_tokens for r in back])[:-1])
    crc = sorted((str(d), binascii.crc32(as_bytes([*ids, 1])))
                 for (d, _), ids in zip(texts, library([t or "" for _, t in texts]), strict=True))
    assert sorted((str(r.doc_id), r.ids_crc32) for r in back) == crc
    # keys that were never written are told apart by their fingerprints
    asked = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.lit(0).cast("bigint").alias("occurrence"))
    assert {r.doc_id for r in O.lookup(asked, out).collect()} == {d for d, _ in texts if d is not None}
    one = O.read(O.lookup(asked.filter("doc_id = 3"), out), out).collect()
    assert len(one) == 1 and len(one[0].ids) == 2 * one[0].length == 2 * 30_001


def test_empty_output(spark):
    out = O.write(documents(spark, []), FILE)
    assert O.read_back(spark, documents(spark, []), out).count() == 0
    assert O.read_back(spark, documents(spark, ["x"]), out).count() == 0


# --- counts ---

def test_counts_query(spark):
    rows = table_rows(SF_SMALL, "documents", "doc_id, text")
    expected = {(d, len((t or "").encode()), len(ids), len(ids) > 2048)
                for (d, t), ids in zip(rows, library([t or "" for _, t in rows]), strict=True)}
    got = Q.queries()["op8_token_counts"](spark, SF_SMALL)
    assert {tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()} == expected


def test_cache_is_used_and_grows_by_misses(spark):
    cache = scratch_path(spark, "cache-test")
    first = documents(spark, ["one two", "one  two\n", "three", None, ""], clash=True)
    assert sorted(r.n_tokens for r in N.counted(first, FILE, cache).collect()) == [0, 0, 1, 2, 2]
    stored = spark.read.parquet(cache)
    assert stored.count() == 3  # white space and null are normalised
    # what is stored is taken, not counted again
    other = scratch_path(spark, "cache-test")
    stored.withColumn("n_tokens", F.col("n_tokens") + 1000).write.parquet(other)
    again = documents(spark, ["one two", "four five six", "four five six", (9, "three")])
    assert sorted(r.n_tokens for r in N.counted(again, FILE, other).collect()) == [3, 3, 1001, 1002]
    assert spark.read.parquet(other).count() == 4
    # another tokenizer has entries of its own
    model = P.path("piece_bpe_32k.model")
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    got = N.counted(again, model, other).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(sp.encode(t)) for t in ("one two", "four five six", "four five six", "three")]
    assert N.counted(documents(spark, []), FILE).count() == 0


def test_limit_and_repeats(spark):
    docs = documents(spark, [(1, "a " * 2048), (1, "a " * 2049), (None, "é")])
    got = N.counted(docs, FILE).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [
        ("1", 4096, 2048, False), ("1", 4098, 2049, True), ("None", 2, 1, False)]


@pytest.mark.parametrize("bound", [None, 0])
def test_only_missing_contents_are_moved(spark, monkeypatch, bound):
    """Digests are joined first, by broadcast or (bound 0) by a bitmap."""
    if bound is not None:
        monkeypatch.setattr(N, "small_side", lambda df: df)
    cache = scratch_path(spark, "cache-test")
    texts = [f"some text number {i % 40}" for i in range(120)]
    before = {r.doc_id: r.n_tokens for r in N.counted(documents(spark, texts), FILE, cache).collect()}
    known = N.read_cache(spark, cache)
    content = N.normaliser(FILE)(F.col("text"))
    rows = lambda t: documents(spark, t).select(F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"), content.alias("content"))
    assert N.missing(rows(texts), known).count() == 0
    assert {r.content for r in N.missing(rows([*texts, "new one", "new one"]), known).collect()} == {"new one"}
    plan = N.missing(rows(texts), known)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "content" in x]
    spark.createDataFrame(known.collect(), N.SCHEMA).write.mode("append").parquet(cache)  # a second writer's append
    again = N.counted(documents(spark, [*texts, "new one"]), FILE, cache).collect()
    assert len(again) == 121 and all(before[r.doc_id] == r.n_tokens for r in again if r.doc_id < 120)
    assert N.read_cache(spark, cache).count() == 2 * 40 + 1
