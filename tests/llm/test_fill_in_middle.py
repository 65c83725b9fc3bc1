import hashlib
import random
import re

import numpy as np
import pytest
from helpers import CLASHING, documents, oracle_rows, result_rows
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimstar.llm import fill_in_middle as M
from dimstar.llm import queries as Q

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_force(i, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return i, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h4 % 100 < 80:
        return i, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return i, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(3)
    alphabet = ["a", "é", "中", "😀", " ", "  ", "\n", "\t", "\x0b", "\x1c", " ", "<", "<P", "S>", "M>", ".", "word"]
    found = ["", None, " ", "\n\n", "x", " x", "x ", "<P>", "a <S> b", "<M", "P>", "<P<S", "<S" * 50 + " x", "a" * 70_000]
    found += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    # segments have to be halved: word lengths change along the text
    found += [" ".join("w" * (1 + (k // 500) % 40) for k in range(20_000)), "é" * 300 + " " + "x " * 40_000]
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    rows = list(enumerate(texts())) + [(None, "one two three four"), (5, "again and again"), (5, "again and again")]
    docs = documents(spark, rows)
    got = M.transformed(docs.repartition(3)).drop("text")
    assert rows_of(got) == sorted((brute_force(*r) for r in rows), key=repr)
    back = M.transformed(docs).select("text", M.restored(F.col("output"), F.col("form")).alias("back"))
    assert back.filter("text <> back").isEmpty()


def test_every_cut_from_the_index(spark):
    """Each boundary of each text is read off segments and residuals alone."""
    rows = list(enumerate(t for t in texts() if t and len(t) < 5000)) + [(9_999, " ".join("w" * (k % 90) for k in range(4000)))]
    index = M.rank_index(documents(spark, rows)).select("doc_id", "n", "segments", "residuals")
    read = M.offset_at(F.col("rank"), F.col("segments"), F.col("residuals")).alias("offset")
    got = index.select("doc_id", "segments", "residuals", F.explode(F.sequence(F.lit(0), "n")).alias("rank")).select(
        "doc_id", "rank", read)
    want = []
    for i, text in rows:
        ends = [0] + [m.end() for m in TOKEN.finditer(text)]
        want += [(i, k, e) for k, e in enumerate(ends)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_segments_are_error_bounded():
    rng = np.random.default_rng(1)
    counts = np.array([1, 2, 5000, 3, 20_000])
    values = np.concatenate([np.concatenate([[0], np.cumsum(rng.integers(1, 2 + 60 * (i % 2), c - 1))])
                             for i, c in enumerate(counts)])
    first, start, rise, run, residuals = M.fit(values, counts)
    assert np.abs(residuals).max() <= M.BOUND and len(first) < len(values) / 50
    owner = np.searchsorted(first, np.arange(len(values)), side="right") - 1
    at = np.arange(len(values)) - first[owner]
    assert (start[owner] + rise[owner] * at // run[owner] + residuals == values).all()


@pytest.mark.parametrize("seed", [42, 7])
def test_other_seeds_cut_elsewhere(spark, seed):
    docs = documents(spark, [" ".join(f"w{k}" for k in range(100))] * 40)
    got = M.transformed(docs, seed=seed, fim_percent=100).select("doc_id", "form", "prefix_chars").collect()
    assert len({r.prefix_chars for r in got}) > 10 and {r.form for r in got} == {"psm", "spm"}


def test_clashing_columns_and_empty_table(spark):
    docs = documents(spark, ["one two", "three"])
    for c in [*CLASHING, "n", "form", "segments", "residuals", "p", "m", "low", "high", "output"]:
        docs = docs.withColumn(c, F.lit("x"))
    assert rows_of(M.transformed(docs).drop("text")) == [brute_force(0, "one two"), brute_force(1, "three")]
    assert M.transformed(docs.limit(0)).count() == 0


def test_registered_query(spark):
    assert result_rows(Q.op12_fill_in_middle(spark, SF_SMALL)) == oracle_rows(SF_SMALL, M.ORACLE_SQL)
