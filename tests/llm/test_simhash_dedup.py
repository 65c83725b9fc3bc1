import random
import re
from itertools import combinations

import pytest
import xxhash
from helpers import documents, table_rows, words

from conftest import SF_SMALL
from dimstar.llm import queries as Q
from dimstar.llm import simhash_dedup as S
from dimstar.llm.components import connected_components


def fingerprint(text, k=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(text)
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, bits):
    """prints: (id, fingerprint) -> {index: smallest id of its component}"""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprint_matches_plain_python():
    for text in ["", " \n\t", "one", "One two", "ÀB c\x0bd e", "a b c d", "x y z " * 300]:
        assert S.fingerprint(text.encode()) == fingerprint(text)


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 997) for i in range(1000))
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "_BLOCK", 64)
    assert S.fingerprint(text.encode()) == whole == fingerprint(text)


@pytest.mark.parametrize("bits", [1, 2, 3])
@pytest.mark.parametrize("max_bucket", [0, 1000])
def test_links_connect_all_close_pairs(spark, bits, max_bucket):
    if bits == 3 and max_bucket == 0:
        pytest.skip("41,664 removals per fingerprint")
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = set(seeds)
    for s in seeds[:8]:
        for _ in range(10):
            x = s
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    found = S.links(spark.createDataFrame(signed, "fp bigint"), bits, max_bucket)
    index = {s[0]: i for i, s in enumerate(signed)}
    pairs = [(index[r.a], index[r.b]) for r in found.collect()]
    assert all((prints[a] ^ prints[b]).bit_count() <= bits for a, b in pairs)
    close = {(i, j) for i in range(len(prints)) for j in range(len(prints))
             if i != j and (prints[i] ^ prints[j]).bit_count() <= bits}
    if max_bucket:
        assert len(pairs) == len(set(pairs)) == len(close) // 2  # each link once
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    assert all(find(i) == find(j) for i, j in close)


def test_query_against_brute_force(spark):
    rows = table_rows(SF_SMALL, "documents", "doc_id, text")
    prints = [(d, fingerprint(t)) for d, t in rows]
    expected = {(d, f"{f:016x}", c) for (d, f), c in zip(prints, components(prints, 2), strict=True)}
    got = Q.queries()["op9_simhash_near_dedup"](spark, SF_SMALL)
    assert {tuple(r) for r in got.select("doc_id", "fingerprint", "component_id").collect()} == expected


def test_defined_cases(spark):
    texts = [(5, None), (3, ""), (9, " \t"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "q r s t u")]
    found = S.near_duplicates(documents(spark, texts, clash=True)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == sorted(
        [("5", "3"), ("3", "3"), ("9", "3"), ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")])
    kept = S.drop_near_duplicates(documents(spark, texts, clash=True))
    assert kept.columns == documents(spark, [], clash=True).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "None", "None"]
    assert S.near_duplicates(documents(spark, [])).count() == 0
    assert S.drop_near_duplicates(documents(spark, [])).count() == 0


def test_one_id_on_several_texts(spark):
    """Each row is judged by its own text, whatever the order of the rows."""
    a, b, c = ("".join(f"{w}{k} " for k in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(1, a), (1, b),                 # unrelated texts: both stay
            (2, c), (3, c), (3, "other words here altogether"),  # a copy under a shared id goes, its namesake stays
            (5, "x y z"), (5, "x y z"), (6, "x y z")]           # equal rows: one stays
    for order in (rows, rows[::-1]):
        for clash in (False, True):
            kept = S.drop_near_duplicates(documents(spark, order, clash=clash).repartition(3))
            assert kept.columns == documents(spark, [], clash=clash).columns
            assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
                [(1, a), (1, b), (2, c), (3, "other words here altogether"), (5, "x y z")])


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    mixed = [(204, 201), (203, 204), (202, 203), (202, 202)]
    df = spark.createDataFrame(chain + star + mixed, "u bigint, v bigint")
    roots = {r.node: r.root for r in connected_components(df).collect()}
    assert roots == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 201 for i in range(201, 205)}}


def test_removals_need_no_expression_per_choice(spark):
    rng = random.Random(5)
    prints = [0, -1, *(rng.getrandbits(64) - (1 << 63) for _ in range(3))]
    fps = spark.createDataFrame([(x,) for x in prints], "fp long")
    for bits in (0, 1, 2):
        found = S.removal_keys(fps, bits)
        masks = [sum(1 << i for i in c) for c in combinations(range(64), bits)]
        unsigned = lambda x: x % (1 << 64)
        assert sorted((unsigned(r.fp), unsigned(r.m), unsigned(r.rest)) for r in found.collect()) == sorted(
            (unsigned(x), m, unsigned(x) & ~m) for x in prints for m in masks)
        assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 4000


def test_exploded_keys_are_not_broadcast(spark, monkeypatch):
    """33 rows are made of a fingerprint, 2,016 of a crowded one: Spark sizes them as if they were one."""
    plans = []
    made = lambda df, name, f=S.materialise: plans.append(df) or f(df, name)
    monkeypatch.setattr(S, "materialise", made)
    fps = spark.createDataFrame([(x,) for x in [*range(40), 1 << 50]], "fp long")
    for found in (S.links(fps, 2, 1000), S.links(fps, 2, 5)):
        links = {(r.a, r.b) for r in found.collect()}
        assert all((a ^ b).bit_count() <= 2 for a, b in links) and {x for ab in links for x in ab} == {*range(40), 1 << 50}
        plans.append(found)
    told = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert sum("SortMergeJoin" in x for x in told) >= 4
    assert not any("BroadcastHashJoin" in x for x in told)
