"""URL filters as a temporal list join, as DataFrame operations only.

A filter list is a log of dated entries: a pattern is added to or removed from
a list on a day. Entries become validity intervals, and every capture of a URL
is judged by the entries that were active on the day it was fetched, not by
today's list.

A pattern is a host (``example.net`` matches itself and its subdomains) or a
host with leading path segments (``example.net/ads``). A capture is turned
into the few patterns that could match it, down to the depths that occur in
the lists, and joined on the pattern and on a span of ``SPAN_DAYS`` days that
both fall in; inside a span the interval must hold the day. The longest active
pattern decides, an allow entry before a block entry of the same length.

Intervals are counted and broadcast only under a bound; otherwise both sides
are shuffled by (pattern, span), and AQE splits a very common host.

Defined cases: entries with a null column, or an action other than ``add`` and
``remove``, are left out; of several entries on one day for a pattern an
``add`` wins; a null or malformed URL, or a null day, matches nothing;
repeated captures each get a result row; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, small_side

SPAN_DAYS = 91


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\s]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    host = F.regexp_replace(host, r"\.$", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path segments of the URL, without query and fragment."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\s]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, allow, pattern, valid_from, valid_to) while a pattern is on a
    list; ``valid_to`` is the first day it is not, null if it still is.

    Entries are first reduced to one per list, pattern and day, so the window
    of one pattern holds at most as many rows as there are days."""
    day = (entries.filter("list IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND allow IS NOT NULL "
                          "AND action IN ('add', 'remove')")
           .groupBy("list", "allow", "pattern", "day").agg(F.max(F.col("action") == "add").alias("active")))
    w = Window.partitionBy("list", "allow", "pattern").orderBy("day")
    # consecutive days in the same state give adjoining intervals; a capture falls into one of them
    return (day.withColumn("valid_to", F.lead("day").over(w)).filter("active")
            .select("list", "allow", "pattern", F.col("day").alias("valid_from"), "valid_to"))


def _span(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SPAN_DAYS).cast("int")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str, url_col: str = "url",
             day_col: str = "fetched_on") -> DataFrame:
    """(id_col, url, fetched_on, n_active, decided_by, verdict) per capture;
    ``verdict`` is block, allow or none. ``entries`` has list, allow
    (boolean), pattern, action and day."""
    rows = captures.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                           F.col(f"`{day_col}`").alias("day"))
    known = materialise(intervals(entries), "url-intervals")
    path_depth = F.size(F.split("pattern", "/")) - 1
    ends = known.agg(F.max(path_depth).alias("path"),
                     F.max(F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))).alias("host")).first()
    days = rows.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    if ends.path is None or days.low is None:
        return _answer(rows, rows.limit(0).select("id", "url", "day", F.lit(0).cast("bigint").alias("n_active"),
                                                  F.lit("").alias("pattern"), F.lit(False).alias("allow")), id_col)
    # only the spans in which something was fetched
    spans = known.select("*", F.explode(F.sequence(
        _span(F.greatest("valid_from", F.lit(days.low))),
        _span(F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(days.high)), F.lit(days.high))))).alias("span")
    ).filter((F.col("valid_from") <= F.lit(days.high))
             & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(days.low))))
    # captures that are alike are judged once, and the answer is joined back
    urls = rows.filter("day IS NOT NULL").select("url", "day").distinct()
    parts = (urls.withColumn("host", host_of(F.col("url"))).filter("host IS NOT NULL")
             .withColumn("labels", F.split("host", r"\.")).withColumn("path", path_of(F.col("url"))))
    labels = F.size("labels")
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), labels - ends.host + 1), labels),
                        lambda i: F.array_join(F.slice("labels", i, labels), "."))
    deep = F.least(F.size("path"), F.lit(ends.path))
    paths = F.when(deep > 0, F.transform(F.sequence(F.lit(1), deep), lambda i: F.concat(
        F.col("host"), F.lit("/"), F.array_join(F.slice("path", F.lit(1), i), "/")))).otherwise(
        F.array().cast("array<string>"))
    asked = parts.select("url", "day", _span(F.col("day")).alias("span"),
                         F.explode_outer(F.concat(hosts, paths)).alias("pattern"))
    spans = materialise(spans, "url-spans")
    active = (asked.join(small_side(spans), ["pattern", "span"])
              .filter("day >= valid_from AND (valid_to IS NULL OR day < valid_to)"))
    best = F.max(F.struct(F.length("pattern").alias("n"), "allow", "pattern")).alias("b")
    found = (active.groupBy("url", "day").agg(F.count(F.lit(1)).alias("n_active"), best)
             .select("url", "day", "n_active", F.col("b.pattern").alias("pattern"), F.col("b.allow").alias("allow")))
    return _answer(rows, materialise(found, "url-found"), id_col)


def _answer(rows: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    known = found.select("url", "day", "n_active", "pattern", "allow")
    return rows.join(known, ["url", "day"], "left").select(
        F.col("id").alias(id_col), "url", F.col("day").alias("fetched_on"),
        F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"), F.col("pattern").alias("decided_by"),
        F.when(F.col("allow"), "allow").when(F.col("allow").isNotNull(), "block").otherwise("none").alias("verdict"))


# --- the registered query's captures and lists, both derived from the pages table ---

FIRST_DAY = "2022-01-01"
DAYS = 900


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages have no fetch time; the query gives them days spread over the
    years by their id."""
    return pages.select("page_id", "url", F.expr(
        f"date_add(date'{FIRST_DAY}', cast(page_id * 37 % {DAYS} AS int))").alias("fetched_on"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated entries about the hosts, parent domains and first path segments
    that the pages have: about a third of them are added to a list by the
    smallest page id they occur with, removed later and partly added again."""
    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), F.element_at(path_of(url), 1).alias("segment")) \
        .filter("host IS NOT NULL AND page_id IS NOT NULL")
    named = seen.select("page_id", F.explode(F.array(
        F.col("host"), F.regexp_replace("host", r"^[^.]*\.", ""),
        F.concat("host", F.lit("/"), "segment"))).alias("pattern"))
    first = named.filter("pattern IS NOT NULL").groupBy("pattern").agg(F.min("page_id").alias("m")).filter("m % 3 <> 1")
    return first.select(F.when(F.col("m") % 4 == 3, "partners").otherwise("spam").alias("list"),
                        (F.col("m") % 4 == 3).alias("allow"), "pattern", F.explode(F.expr(f"""array(
        named_struct('action', 'add', 'day', date_add(date'{FIRST_DAY}', cast(m * 53 % 600 AS int))),
        named_struct('action', 'remove', 'day', date_add(date'{FIRST_DAY}', cast(m * 53 % 600 + 30 + m % 200 AS int))),
        named_struct('action', CASE WHEN m % 2 = 0 THEN 'add' ELSE 'remove' END,
                     'day', date_add(date'{FIRST_DAY}', cast(m * 53 % 600 + 260 AS int))))""")).alias("e")) \
        .select("list", "allow", "pattern", "e.action", "e.day")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2022-01-01' + CAST(page_id * 37 % 900 AS INT) AS fetched_on,
         regexp_replace(lower(regexp_replace(regexp_replace(
           regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\s]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '\.$', '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\s]*([^?#]*)', 1), '/'), lambda s: s <> '') AS path
  FROM pages),
named AS (
  SELECT page_id, unnest([host, regexp_replace(host, '^[^.]*\.', ''), host || '/' || path[1]]) AS pattern
  FROM p WHERE host <> '' AND page_id IS NOT NULL),
f AS (SELECT pattern, min(page_id) AS m FROM named WHERE pattern IS NOT NULL GROUP BY pattern HAVING min(page_id) % 3 <> 1),
e AS (
  SELECT pattern, m % 4 = 3 AS allow, DATE '2022-01-01' + CAST(m * 53 % 600 AS INT) AS day, true AS active FROM f
  UNION ALL SELECT pattern, m % 4 = 3, DATE '2022-01-01' + CAST(m * 53 % 600 + 30 + m % 200 AS INT), false FROM f
  UNION ALL SELECT pattern, m % 4 = 3, DATE '2022-01-01' + CAST(m * 53 % 600 + 260 AS INT), m % 2 = 0 FROM f),
d AS (SELECT pattern, allow, day, max(active) AS active FROM e GROUP BY ALL),
last AS (  -- the latest entry on or before the fetch day, per capture and pattern
  SELECT p.page_id, p.url, p.fetched_on, d.pattern, d.allow, max_by(d.active, d.day) AS active
  FROM p JOIN d ON d.day <= p.fetched_on AND (p.host = d.pattern OR ends_with(p.host, '.' || d.pattern)
       OR starts_with(p.host || '/' || array_to_string(p.path, '/') || '/', d.pattern || '/') AND contains(d.pattern, '/'))
  GROUP BY ALL),
a AS (SELECT page_id, url, fetched_on, count(*) AS n, max_by(pattern, (length(pattern), allow, pattern)) AS pattern,
             max_by(allow, (length(pattern), allow, pattern)) AS allow
      FROM last WHERE active GROUP BY ALL)
SELECT p.page_id, p.url, p.fetched_on, coalesce(a.n, 0) AS n_active, a.pattern AS decided_by,
       CASE WHEN a.allow IS NULL THEN 'none' WHEN a.allow THEN 'allow' ELSE 'block' END AS verdict
FROM p LEFT JOIN a ON a.page_id = p.page_id
"""
