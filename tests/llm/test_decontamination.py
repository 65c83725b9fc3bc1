import math
import random
from itertools import combinations

import pytest
from helpers import documents, oracle_rows, result_rows
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimstar.llm import decontamination as D
from dimstar.llm import queries as Q

ITEMS = "item_id bigint, text string"


def test_masks_find_every_window_with_two_substitutions():
    at = [sum(1 << s + i for i, c in enumerate(m) if c == "1") for m in D.MASKS for s in range(D.WINDOW - len(m) + 1)]
    for c in combinations(range(D.WINDOW), 2):
        changed = sum(1 << i for i in c)
        assert any(not p & changed for p in at)
    assert D.WINDOW - math.ceil(D.WINDOW * D.MIN_EQUAL) == 2


def brute_force(docs, items):
    out = {}
    for d, t in docs:
        w = t.lower().split()
        for i, x in items:
            b = x.lower().split()
            need, best = min(D.WINDOW, len(b)), None
            for g in range(-len(b), len(w)):
                first, n = max(g, 0), min(g + len(b), len(w)) - max(g, 0)
                if n < need:
                    continue
                same = [w[first + k] == b[first - g + k] for k in range(n)]
                if max(sum(same[k:k + need]) for k in range(n - need + 1)) >= math.ceil(need * D.MIN_EQUAL):
                    best = max(best or (0,), (sum(same), n, -first))
            if best:
                out[d, i] = (d, i, -best[2], best[1], best[0])
    return sorted(out.values())


def test_against_all_alignments(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(13, 40)))) for i in range(12)]
    docs = []
    for d in range(60):
        w = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if d % 2:
            p = rng.choice(items)[1].split()
            a = rng.randrange(0, len(p) - 8)
            p = p[a:a + rng.randrange(8, 40)]
            for _ in range(rng.randrange(0, 5)):
                p[rng.randrange(len(p))] = "other"
            cut = rng.randrange(len(w) + 1)
            w = w[:cut] + p + w[cut:]
        docs.append((d, " ".join(w)))
    found = D.contaminated(documents(spark, docs), spark.createDataFrame(items, ITEMS))
    assert sorted(tuple(r) for r in found.collect()) == brute_force(docs, items)


@pytest.mark.parametrize("n", range(1, 14))
def test_masks_of_every_length_leave_one_free(n):
    masks = (*D.MASKS, *D.masks_for(n))
    at = [{s + i for i, c in enumerate(m) if c == "1"} for m in masks for s in range(n - len(m) + 1)]
    for c in combinations(range(n), n - math.ceil(n * D.MIN_EQUAL)):
        assert any(p.isdisjoint(c) for p in at)
    assert n < 12 or D.masks_for(n) == ()


def test_short_items_against_all_alignments(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 13)] + [(20, "the"), (21, "a b a b a")]
    docs = [(0, "the end of the a b a x a b a b")]
    for n, text in items[:12]:
        wrong = n - math.ceil(n * D.MIN_EQUAL)
        for size in {wrong, wrong + 1}:  # the last size is not accepted
            for c in combinations(range(n), size):
                w = ["zzz" if i in c else x for i, x in enumerate(text.split())]
                docs.append((len(docs), " ".join(["p"] * (len(docs) % 3) + w + ["q"] * (len(docs) % 2))))
    expected = brute_force(docs, items)
    assert {i for _, i, *_ in expected} == {i for i, _ in items}
    found = D.contaminated(documents(spark, docs), spark.createDataFrame(items, ITEMS))
    assert sorted(tuple(r) for r in found.collect()) == expected
    wide = D.contaminated(documents(spark, docs), spark.createDataFrame(items[:10], ITEMS), window=4)
    assert {r.item_id for r in wide.collect()} == set(range(1, 11))


def test_query_matches_oracle(spark):
    name = "op1_decontamination"
    assert result_rows(Q.queries()[name](spark, SF_SMALL)) == oracle_rows(SF_SMALL, Q.oracle_sql()[name])


def test_shuffle_join_above_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(D, "small_side", lambda df, *a: df)
    name = "op1_decontamination"
    assert result_rows(Q.queries()[name](spark, SF_SMALL)) == oracle_rows(SF_SMALL, Q.oracle_sql()[name])


def test_defined_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (None, passage), (4, "too short")], ITEMS)
    long = " ".join(f"x{i % 500}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, "!!! ???"), (4, f"{long} {passage.upper()}! {long}"), (5, passage), (5, passage),
            (None, passage), (6, "clean words only")]
    found = D.contaminated(documents(spark, docs, clash=True), items)
    assert sorted(tuple(r) for r in found.collect()) == [(4, 1, 60_000, 14, 14), (5, 1, 0, 14, 14)]
    kept = D.drop_contaminated(documents(spark, docs, clash=True), items)
    assert kept.columns == documents(spark, [], clash=True).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "6", "None"]
    assert D.contaminated(documents(spark, []), items).count() == 0
    assert D.contaminated(documents(spark, docs), items.limit(0)).count() == 0


@pytest.mark.parametrize("changed", [{3, 9}, {0, 12}, {6}])
def test_substituted_copy_is_found(spark, changed):
    passage = [f"p{i}" for i in range(13)]
    copy = ["zzz" if i in changed else w for i, w in enumerate(passage)]
    found = D.contaminated(documents(spark, [" ".join(["a"] * 5 + copy + ["b"] * 5)]),
                           spark.createDataFrame([(7, " ".join(passage))], ITEMS))
    assert [tuple(r) for r in found.collect()] == [(0, 7, 5, 13, 13 - len(changed))]


def test_one_id_on_several_texts(spark):
    """A clean text stays though a contaminated one has its id, in any order."""
    item = " ".join(f"bench{k}" for k in range(30))
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = [(5, "before " + item + " after"), (5, "a clean text"), (6, item), (7, "clean too"), (8, item), (8, "x " + item), (None, item)]
    for order in (rows, rows[::-1]):
        for clash in (False, True):
            kept = D.drop_contaminated(documents(spark, order, clash=clash), items)
            assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("5", "a clean text"), ("7", "clean too"), ("None", item)]


def test_windows_against_every_count_of_differences(spark):
    """Differences at the ends, in runs and spread, around the accepted number."""
    rng = random.Random(8)
    items = [(1, " ".join(f"p{i}" for i in range(40))), (2, " ".join(f"q{i}" for i in range(13)))]
    docs = []
    for d in range(150):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 16)):
            w[rng.randrange(len(w))] = "zzz"
        at = rng.randrange(len(w))
        docs.append((d, " ".join((w[at:] if d % 3 else w[:at]) if d % 5 == 0 else w)))
    found = D.contaminated(documents(spark, docs), spark.createDataFrame(items, ITEMS))
    want = brute_force(docs, items)
    assert sorted(tuple(r) for r in found.collect()) == want and 20 < len(want) < 140


def test_one_token_repeated_in_item_and_document(spark):
    """Every diagonal has hits; each is verified in linear time (minutes before)."""
    items = spark.createDataFrame([(1, " ".join(["la"] * 300)), (2, " ".join(["la", "lu"] * 50))], ITEMS)
    docs = [(1, " ".join(["la"] * 10_000)), (2, "clean text"), (3, " ".join(["lu", "la"] * 60))]
    found = D.contaminated(documents(spark, docs), items)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 0, 300, 300), (3, 2, 1, 100, 100)]


def test_compiled_keys_of_a_place_are_those_of_the_arrays(spark):
    """One row per token and plain columns, where arrays of keys were made token by token."""
    rows = [(k, [(k * 31 + j) % 7 for j in range(k)]) for k in range(14)]
    df = spark.createDataFrame(rows, "k long, h array<bigint>")
    masks = (*D.MASKS, "1", "1101")
    n, longest = F.size("h"), max(map(len, masks))
    arrays = df.select("k", F.array(*[D._keys(F.col("h"), n, m, mask) for m, mask in enumerate(masks)]).alias("keys"))
    places = (df.select("k", "h", n.alias("n"), F.explode(F.when(n > 0, F.sequence(F.lit(1), n))).alias("i"))
              .select("k", "n", "i", *[F.get("h", F.col("i") + (o - 1)).alias(f"h{o}") for o in range(longest)])
              .select("k", "i", F.array(*[D._key_here(m, mask) for m, mask in enumerate(masks)]).alias("keys")))
    want = {r.k: r["keys"] for r in arrays.collect()}
    got = {(r.k, r.i): r["keys"] for r in places.collect()}
    assert len(got) == sum(range(14))
    for (k, i), keys in got.items():
        assert keys == [w[i - 1] if i <= len(w) else None for w in want[k]]


def test_the_scan_has_no_interpreted_keys(spark, monkeypatch):
    """The texts' tokens are hashed once per document, and the keys of their
    places are not functions over an array."""
    plans, written = {}, D.materialise

    def kept(df, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, name, **options)

    monkeypatch.setattr(D, "materialise", kept)
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(20)))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(15)))], ITEMS)
    assert [(r.doc_id, r.item_id, r.start) for r in D.contaminated(docs, items).collect()] == [(1, 7, 1)]
    assert plans["decontam-hits"].count("lambdafunction(xxhash64") == 1


def test_windows_are_not_broadcast(spark, monkeypatch):
    """Seeds over the measured bound: a row per token and mask is no small side either, though its documents are."""
    plans, written = {}, D.materialise

    def kept(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name, **options)

    monkeypatch.setattr(D, "materialise", kept)
    monkeypatch.setattr(D, "small_side", lambda df, *most: df)
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(20)))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(f"w{i}" for i in range(15)))], ITEMS)
    assert [(r.doc_id, r.item_id, r.start) for r in D.contaminated(docs, items).collect()] == [(1, 7, 1)]
    assert "SortMergeJoin [key" in plans["decontam-hits"]
