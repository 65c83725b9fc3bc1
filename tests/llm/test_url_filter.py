import datetime as dt
import random

from helpers import oracle_rows, result_rows

from conftest import SF_SMALL
from dimstar.llm import queries as Q
from dimstar.llm import url_filter as U

ENTRIES = "list string, allow boolean, pattern string, action string, day date"
CAPTURES = "page_id bigint, url string, fetched_on date, id string, pattern string"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_query_matches_oracle(spark):
    name = "op5_url_filter"
    assert result_rows(Q.queries()[name](spark, SF_SMALL)) == oracle_rows(SF_SMALL, Q.oracle_sql()[name])


def test_hosts_and_paths(spark):
    urls = ["http://A.Example.com:8080/x//y?z#f", "https://user:pw@host.net./", "ftp://h", "no url", "", None,
            "http:///path", "http://h?q=a/b"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [(r.h, r.p) for r in df.select(U.host_of(df.url).alias("h"), U.path_of(df.url).alias("p")).collect()]
    assert got == [("a.example.com", ["x", "y"]), ("host.net", []), ("h", []), (None, []), (None, []), (None, None),
                   (None, ["path"]), ("h", [])]


def test_against_replay_of_the_log(spark, monkeypatch):
    monkeypatch.setattr(U, "SPAN_DAYS", 7)
    rng = random.Random(2)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c.net"]
    patterns = hosts + ["com", "x.a.com/p", "a.com/p/q", "b.org/z"]
    log = [(f"l{k}", bool(k), rng.choice(patterns), rng.choice(["add", "remove"]), day(rng.randrange(60)))
           for _ in range(150) for k in [rng.randrange(2)]]
    captures = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['', 'p', 'p/q', 'p/q/r', 'z'])}", day(rng.randrange(-5, 90)))
                for i in range(300)]
    expected = {}
    for i, url, d in captures:
        host, _, path = url.removeprefix("http://").partition("/")
        full = host + "".join("/" + s for s in path.split("/") if s)
        active = []
        for name, allow, pattern in {e[:3] for e in log}:
            matches = (full + "/").startswith(pattern + "/") if "/" in pattern else ("." + host).endswith("." + pattern)
            past = [e for e in log if e[:3] == (name, allow, pattern) and e[4] <= d]
            last = [e for e in past if e[4] == max(x[4] for x in past)]
            if matches and any(e[3] == "add" for e in last):
                active.append((len(pattern), allow, pattern))
        top = max(active, default=None)
        expected[i] = (len(active), top and top[2], "none" if not top else "allow" if top[1] else "block")
    got = U.evaluate(spark.createDataFrame([(*c, "x", "x") for c in captures], CAPTURES),
                     spark.createDataFrame(log, ENTRIES), "page_id")
    assert {r.page_id: (r.n_active, r.decided_by, r.verdict) for r in got.collect()} == expected


def test_defined_cases(spark):
    log = [("l", False, "a.com", "add", day(5)), ("l", False, "a.com", "remove", day(5)), ("l", False, "a.com", "odd", day(6)),
           (None, False, "b.com", "add", day(0)), ("l", None, "b.com", "add", day(0)), ("l", False, None, "add", day(0)),
           ("l", False, "b.com", None, day(0)), ("l", False, "b.com", "add", None)]
    captures = [(1, "http://a.com/", day(5)), (1, "http://a.com/", day(5)), (2, "http://a.com/", day(4)), (3, None, day(5)),
                (4, "http://a.com", None), (None, "http://a.com", day(99)), (5, "http://b.com", day(9)),
                (6, "http://a.com/" + "s/" * 20_000, day(7))]
    rows = spark.createDataFrame([(*c, "x", "x") for c in captures], CAPTURES)
    got = U.evaluate(rows, spark.createDataFrame(log, ENTRIES), "page_id")
    assert sorted((str(r.page_id), r.verdict) for r in got.collect()) == [
        ("1", "block"), ("1", "block"), ("2", "none"), ("3", "none"), ("4", "none"), ("5", "none"), ("6", "block"),
        ("None", "block")]
    assert {r.verdict for r in U.evaluate(rows, spark.createDataFrame([], ENTRIES), "page_id").collect()} == {"none"}
    assert U.evaluate(rows.limit(0), spark.createDataFrame(log, ENTRIES), "page_id").count() == 0
