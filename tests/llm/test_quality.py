import random
import re
import zlib

import pytest
from helpers import LABELS, documents, table_rows, words

from conftest import SF_MID
from dimstar.llm import quality_classifier as C
from dimstar.llm import quality_rules as R
from dimstar.llm import queries as Q
from dimstar.llm import text_stats as S


def base_counts(text):
    w = words(text)
    seen, dup, covered = set(), 0, set()
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_counts_against_plain_python(monkeypatch):
    rng = random.Random(1)
    for n in range(120):
        text = "".join(rng.choice(["a", "b", "É ", " ", " ", "\n", "\n", "|", "*", "中", "\t", "\x0b", "a b a b c\n"])
                       for _ in range(rng.randrange(90)))
        if n % 2:
            monkeypatch.setattr(S, "_LONG", 0)
        got = S.counts(text.encode())
        monkeypatch.undo()
        assert got[:5] == base_counts(text)
    assert S.counts(None) == S.counts(b"") == (0,) * len(S.COUNTS)


def test_rules_query(spark):
    texts = dict(table_rows(SF_MID, "documents", "doc_id, text"))
    quality = dict(table_rows(SF_MID, "labels", "doc_id, quality"))
    rows = Q.queries()["op2_quality_rules"](spark, SF_MID).collect()
    assert len(rows) == len(texts)
    right = {0: [], 1: []}
    for r in rows:
        n, chars, symbols, dup, repeat = expected = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in quality:
            right[quality[r.doc_id]].append(r.kept == (quality[r.doc_id] == 1))
    assert sum(right[1]) / len(right[1]) > 0.97 and sum(right[0]) / len(right[0]) > 0.9


def test_forest_paths(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    clean = np.column_stack([rng.normal(0, 1, 4000), np.zeros(4000)])
    forest = R.Forest(clean, np.array([-6.0, 0.0]), np.array([6.0, 3.0]), trees=50)
    scores = forest.scores(np.array([[0.0, 0.0], [6.0, 0.0], [0.0, 2.0]]))
    assert scores[1] > scores[0] and scores[2] > scores[0] + 0.1  # constant among clean rows, still isolated
    assert abs(R._mean_path(256) - 10.244) < 0.01 and R._mean_path(1) == 0


def test_classifier_query(spark):
    quality = dict(table_rows(SF_MID, "labels", "doc_id, quality"))
    rows = Q.queries()["op4_quality_classifier"](spark, SF_MID).collect()
    assert len(rows) == len(table_rows(SF_MID, "documents", "doc_id"))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    junk = [p for p, y in held if y == 0]
    assert junk.count(0) / len(junk) > 0.85


def test_rules_hold_for_their_rows(spark):
    """Every tree path, compiled, selects the rows that the bounds describe."""
    rule = C.Rule((("symbols", 0.1, float("inf")), ("upper", float("-inf"), 0.5)))
    df = S.with_counts(documents(spark, ["### a b", "AAAA BBB ###", "plain words"]), "text")
    assert [r.v for r in df.select("row.doc_id", rule.column().alias("v")).orderBy("doc_id").collect()] == \
        [True, True, False]


def test_held_out_labels_do_not_matter(spark):
    texts = [f"good words number {i} in a text of some length and so on. Again." for i in range(60)] + \
        [f"*** ### %%% {i} &&& $$$ ***" for i in range(60)]
    docs = documents(spark, texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    score = lambda flip: [r.score for r in C.scored(docs, spark.createDataFrame(
        [(i, int((i < 60) != (flip and held(i))), 0) for i in range(120)], LABELS)).orderBy("row.doc_id").collect()]
    assert score(False) == score(True)


@pytest.mark.parametrize("labels", [[], [(0, 1, 0)], [(0, 0, 0), (1, None, 0), (None, 1, 0)],
                                    [(0, 1, 0), (0, 0, 0), (2, 1, 0), (3, 0, 0), (3, 0, 0), (4, 1, 0), (6, 7, 0)]])
def test_defined_cases(spark, labels):
    long = "many words " * 50_000
    texts = [(0, "a few good words in a row that make a text of more than ten."), (1, None), (2, ""), (3, "### " * 30),
             (4, long), (4, long), (None, "Some words that belong to nobody but are enough to pass the rules.")]
    docs, known = documents(spark, texts, clash=True), spark.createDataFrame(labels, LABELS)
    for op in (C, R):
        kept = op.drop_rejected(docs, known)
        assert kept.columns == docs.columns and kept.schema["doc_id"] == docs.schema["doc_id"]
        kept.collect()
        assert op.drop_rejected(docs.limit(0), known).count() == 0
    judged = R.judged(docs, known).collect()
    assert sorted(str(r.row.doc_id) for r in judged) == sorted(str(i) for i, _ in texts)
    assert all(r.base_failed and not r.kept for r in judged if r.row.doc_id in (1, 2, 4))
    scored = C.scored(docs, known).collect()
    assert len(scored) == len(texts) and all(0 <= r.score <= 1 for r in scored)
