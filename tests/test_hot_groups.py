import datetime as dt

import pytest

from dimstar.operators import fact as FT
from dimstar.operators import segmented as S


def rows(spark):
    return spark.createDataFrame(
        [(g, t, t if t % 3 == 0 else None) for g, n in (("a", 40), ("b", 2), ("c", 7), (None, 5)) for t in range(n)],
        "g string, t int, v int")


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_groups_of_any_size_have_the_same_results(spark, monkeypatch, most):
    monkeypatch.setattr(S, "HOT_ROWS", most)
    cut = []
    monkeypatch.setattr(S, "segment", lambda *a, f=S.segment, **k: cut.append(1) or f(*a, **k))
    df = rows(spark).where("g is not null")
    got = lambda x: sorted(tuple(r) for r in x.select("g", "t", "o").collect())
    of = lambda f: sorted((g, t, f(t, n)) for g, n in (("a", 40), ("b", 2), ("c", 7)) for t in range(n))
    assert got(S.ffill_in_group(df, ["g"], ["t"], "v", "o")) == of(lambda t, n: t - t % 3)
    assert sorted((r.g, r.t, -1 if r.o is None else r.o) for r in S.lag_in_group(df, ["g"], ["t"], "t", "o").collect()) == of(
        lambda t, n: t - 1)
    led = S.lead_in_group(df, ["g"], ["t"], "t", "o", "more").collect()
    assert sorted((r.g, r.t, r.o if r.more else -1) for r in led) == of(lambda t, n: t + 1 if t + 1 < n else -1)
    assert got(S.running_sum_in_group(df, ["g"], ["t"], "t", "o")) == of(lambda t, n: t * (t + 1) // 2)
    assert bool(cut) == (most < 40)  # nothing is stored for groups that a task can order


def test_null_group_is_filled(spark):
    found = S.ffill_in_group(rows(spark).where("g is null"), ["g"], ["t"], "v", "o").collect()
    assert sorted((r.t, r.o) for r in found) == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3)]


def test_customer_key_is_looked_up_once_per_customer_and_time(spark, monkeypatch):
    at = lambda d: dt.datetime(2025, 1, d)
    customers = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "id bigint, fiscal_code_hash string")
    dim = spark.createDataFrame([("p", at(1), at(5), 10), ("p", at(5), None, 11), ("q", at(3), None, 12)],
                                "fiscal_code_hash string, valid_from timestamp_ntz, valid_to timestamp_ntz, customer_key bigint")
    asked = [(100, 1, at(2)), (101, 1, at(2)), (102, 1, at(2)), (103, 2, at(5)), (104, 2, at(9)), (105, 3, at(1)),
             (106, 3, None), (107, None, at(4)), (108, 9, at(4)), (108, 1, at(2))]
    requests = spark.createDataFrame(asked, "id bigint, customer_id bigint, request_datetime timestamp_ntz")
    probed = []
    monkeypatch.setattr(FT, "asof_join", lambda p, *a, f=FT.asof_join, **k: probed.append(p.count()) or f(p, *a, **k))
    want = sorted([(100, 10), (101, 10), (102, 10), (103, 11), (104, 11), (105, -1), (106, -1), (107, -1), (108, -1), (108, 10)])
    got = FT.customer_keys(requests, customers, dim).collect()
    assert sorted((r.id, -1 if r.customer_key is None else r.customer_key) for r in got) == want
    assert probed == [7]
