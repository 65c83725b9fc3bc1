import hashlib
from collections import defaultdict
from itertools import permutations

import pytest
from helpers import CLASHING, DOCS, LABELS, oracle_rows, result_rows, words
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimstar.llm import filter_audit as A
from dimstar.llm import queries as Q

LONG = " ".join(f"word{i}" for i in range(250))
MANY = [(0, LONG, "a"), (1, LONG, "a"), (2, LONG, "b"), (3, "same " * 400, "a"), (4, "SHOUT " * 300, None), (5, None, ""),
        (6, "", "b"), (7, "", None), (None, LONG, "a"), (None, LONG, "a"), (8, "hash # tag", "b"), (8, "hash # tag", "b"),
        (8, LONG, "c"), (9, " \n\t ", "c"), (10, "x y Über É " * 200, "c"), (11, LONG + " $5", "a"), (12, " ".join("ab" for _ in range(60_000)), "a")]
MARKS = [(0, 1, 0), (1, 1, 0), (1, 0, 1), (3, 0, 1), (None, 1, 1), (8, 1, None), (11, 1, 1), (11, 1, 1), (99, 1, 1)]


def brute_force(rows, marks):
    good, toxic = ({i for i, *m in marks if m[k] == 1 and i is not None} for k in (0, 1))
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    docs = []
    for i, text, part in rows:
        text, w = text or "", words(text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": i is not None and i > first[text]}
        docs.append((part or "", {x for x in fails if fails[x]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine, shapley, found = [d for d in docs if d[0] == part], defaultdict(int), []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                found.append((part, "".join(order), step, len(left), len(gone), sum(x in d[1] for d in mine) - len(gone),
                              sum(d[1] == {x} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*f, shapley[f[1][f[2] - 1]]) for f in found]
    return sorted(out)


def tables(spark, rows, marks):
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    return docs, spark.createDataFrame(marks, LABELS)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(spark, clash):
    docs, labels = tables(spark, MANY, MARKS)
    for c in [*CLASHING, "words", "mask", "part", "digest", "steps", "step", "n"] if clash else []:
        docs = docs.withColumn(c, F.lit("x"))
        labels = labels if c == "quality" else labels.withColumn(c, F.lit("y"))
    assert rows_of(A.audit(docs.repartition(5), labels)) == brute_force(MANY, MARKS)


def test_empty_tables(spark):
    docs, labels = tables(spark, MANY[:4], MARKS)
    assert rows_of(A.audit(docs.limit(0), labels)) == []
    assert rows_of(A.audit(docs, labels.limit(0))) == brute_force(MANY[:4], [])


def test_registered_query(spark):
    assert result_rows(Q.op11_filter_audit(spark, SF_SMALL)) == oracle_rows(SF_SMALL, A.ORACLE_SQL)


def test_copies_are_combined_before_they_are_shuffled_by_text(spark):
    """Each cell arrives once per task and text, whatever the number of copies."""
    docs, labels = tables(spark, [(i, "copy", "a") for i in range(2000)], [])
    cells = A.mask_cells(A.failures(docs, A.FILTERS), labels, 4)
    got = {r["mask"]: r["n"] for r in cells.collect()}
    assert got == {0b00001: 1, 0b10001: 1999}
    assert hashlib.sha256(b"copy").digest() == bytes(A.failures(docs, A.FILTERS).first()["digest"])
