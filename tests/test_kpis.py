import datetime as dt

import pytest

from conftest import SF_SMALL
from dimstar.model import KpiParams
from dimstar.operators import checks as C
from dimstar.operators import kpis as K
from dimstar.sources.driver import driver_star

FULL = KpiParams.of("1995-01-01", "2001-12-31")
EMPTY = KpiParams.of("1995-01-01", "2001-12-31", province="ZZ")


@pytest.fixture(scope="module")
def star(spark):
    return driver_star(spark, SF_SMALL)


def test_empty_set_big_numbers(star):
    for fn, value, reason in [(K.kpi_request_count, 0, None), (K.kpi_revenue, 0.0, None),
                              (K.kpi_active_customers, 0, None),
                              (K.kpi_mean_duration, None, "no_completed_requests"),
                              (K.kpi_cancel_rate, None, "no_requests_in_denominator"),
                              (K.kpi_retention, None, "no_requests_in_denominator")]:
        r = fn(star, EMPTY).collect()[0]
        assert (r.value, r.reason) == (value, reason), fn.__name__
        assert r.province == "ZZ" and r.period_start == dt.date(1995, 1, 1)


def test_empty_set_tables_keep_schema(star):
    for fn, cols in [(K.kpi_revenue_by_province, ["province", "revenue_in_province", "n_requests_in_province"]),
                     (K.trend_weekly, ["period_label", "n_requests"]),
                     (K.top_suppliers, ["supplier_name", "category", "revenue_eur", "n_requests"]),
                     (K.province_category, ["province", "category", "n_requests"])]:
        df = fn(star, EMPTY)
        assert df.columns == cols and df.count() == 0


@pytest.mark.parametrize("start,end,gran", [("2025-01-01", "2025-04-01", "daily"),
                                            ("2025-01-01", "2025-04-02", "weekly"),
                                            ("2025-01-02", "2025-01-01", "daily")])
def test_granularity(start, end, gran):
    assert K.trend_granularity(KpiParams.of(start, end)) == gran


def test_end_before_start_is_empty(star):
    assert K.trend(star, KpiParams.of("1999-01-02", "1999-01-01")).count() == 0


def test_malformed_period_fails_on_driver():
    with pytest.raises(ValueError):
        KpiParams.of("2025-13-01", "2025-12-31")


def test_summary_equals_single_kpis(star):
    s = K.kpi_summary(star, FULL).collect()[0]
    assert s.n_requests == K.kpi_request_count(star, FULL).collect()[0].value
    assert s.active_customers == K.kpi_active_customers(star, FULL).collect()[0].value
    assert s.revenue == K.kpi_revenue(star, FULL).collect()[0].value
    assert abs(s.cancel_rate - K.kpi_cancel_rate(star, FULL).collect()[0].value) < 1e-12
    assert abs(s.retention - K.kpi_retention(star, FULL).collect()[0].value) < 1e-12
    assert abs(s.mean_duration - K.kpi_mean_duration(star, FULL).collect()[0].value) < 1e-9


def test_invariants(star):
    assert C.kpi_reconcile(star, FULL).collect()[0].ok
    assert C.ratio_range(star, FULL).collect()[0].ok
    assert C.filter_monotonic(star, FULL, KpiParams.of("1995-01-01", "2001-12-31", province="NATION_3")).collect()[0].ok
    assert C.label_format(K.trend_weekly(star, FULL), "weekly").collect()[0].ok
    assert C.label_format(K.trend_daily(star, KpiParams.of("1996-01-01", "1996-03-31")), "daily").collect()[0].ok
    assert K.top_suppliers(star, FULL).count() == 5


def test_empty_string_is_a_real_filter(star):
    # only None switches a filter off; '' matches no province
    r = K.kpi_request_count(star, KpiParams.of("1995-01-01", "2001-12-31", province="")).collect()[0]
    assert r.value == 0 and r.province == ""


def test_null_parameters_fold_away(spark, star):
    from dimstar.plans.sql_api import run_sql
    df = run_sql(spark, star, "cancel_rate", FULL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "province" not in plan and "category" not in plan  # both filters folded, columns pruned
    a = df.collect()[0].value
    b = K.kpi_cancel_rate(star, FULL).collect()[0].value
    assert abs(a - b) < 1e-12


def test_customer_join_on_orders_side_is_equivalent(star):
    """The driver star joins customers on the orders side; without the hook
    the plain K0 order must give the same results."""
    from dataclasses import replace
    plain = replace(star, fact_with_customers=None)
    for p in (FULL, KpiParams.of("1996-01-01", "1996-12-31", province="NATION_3", category="EUROPE")):
        for fn in (K.kpi_summary, K.province_category, K.top_suppliers, K.trend_weekly):
            assert sorted(fn(star, p).collect()) == sorted(fn(plain, p).collect()), fn.__name__


def test_kpis_random_star_against_python(spark):
    """Orphan keys, dates outside the calendar, NULL durations, a NULL
    province: K0 keeps only fully joined rows in the period; the KPIs equal a
    plain-Python computation."""
    import random

    from dimstar.model import Star
    from dimstar.operators.dims import build_time_dim

    rnd = random.Random(5)
    provs = ["RM", "MI", "NA", None]
    cust = [(k, f"p{k % 7}", provs[k % 4]) for k in range(1, 21)]
    sup = [(k, f"s{k}", ["a", "b"][k % 2]) for k in range(1, 6)]
    facts = []
    for i in range(600):
        d = dt.date(2024, 12, 25) + dt.timedelta(days=rnd.randint(0, 380))
        status = rnd.choice(["booked", "confirmed", "completed", "invoiced", "cancelled"])
        done = status in ("completed", "invoiced")
        facts.append((i, rnd.randint(1, 22), rnd.randint(1, 6), d.year * 10000 + d.month * 100 + d.day,
                      rnd.randint(100, 99999) / 100, rnd.choice([None, rnd.randint(5, 90)]) if done else None,
                      1 if done else 0, 1 if status == "cancelled" else 0))
    star = Star(
        fact=spark.createDataFrame(facts, "request_id int, customer_key int, supplier_key int, date_key int, "
                                          "price double, service_duration_minutes int, is_completed int, is_cancelled int"),
        time_dim=build_time_dim(spark, dt.date(2025, 1, 1), dt.date(2025, 12, 31)),
        customer_dim=spark.createDataFrame(cust, "customer_key int, fiscal_code_hash string, province string"),
        supplier_dim=spark.createDataFrame(sup, "supplier_key int, name string, category string"),
        calendar_days=365)
    cmap, smap = {c[0]: c for c in cust}, {s[0]: s for s in sup}
    for prov, cat in [(None, None), ("RM", None), (None, "b"), ("MI", "a")]:
        p = KpiParams.of("2025-02-01", "2025-10-31", province=prov, category=cat)
        lo, hi = 20250201, 20251031
        rows = [f for f in facts if lo <= f[3] <= hi and f[1] in cmap and f[2] in smap
                and (prov is None or cmap[f[1]][2] == prov) and (cat is None or smap[f[2]][2] == cat)]
        done = [f for f in rows if f[6] == 1 and f[7] == 0]
        per = {}
        for f in rows:
            per[cmap[f[1]][1]] = per.get(cmap[f[1]][1], 0) + 1
        durs = [f[5] for f in done if f[5] is not None]
        s = K.kpi_summary(star, p).collect()[0]
        assert s.n_requests == len(rows)
        assert abs(s.revenue - sum(round(f[4] * 100) for f in done) / 100) < 1e-9
        assert (s.mean_duration is None and not durs) or abs(s.mean_duration - sum(durs) / len(durs)) < 1e-9
        assert s.active_customers == len(per)
        assert abs(s.cancel_rate - sum(f[7] for f in rows) / len(rows)) < 1e-12
        assert abs(s.retention - sum(1 for n in per.values() if n >= 2) / len(per)) < 1e-12
        byp = {r.province: (r.revenue_in_province, r.n_requests_in_province)
               for r in K.kpi_revenue_by_province(star, p).collect()}
        expp = {}
        for f in done:
            pv = cmap[f[1]][2]
            c, n = expp.get(pv, (0, 0))
            expp[pv] = (c + round(f[4] * 100), n + 1)
        assert byp == {k: (c / 100, n) for k, (c, n) in expp.items()}


def test_revenue_keeps_sub_cent_prices(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(0.1,)] * 3, "price double")
    assert df.agg(K.money_sum("price").alias("v")).first().v == 4.3
