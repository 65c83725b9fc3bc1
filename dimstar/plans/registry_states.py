"""Registered queries of the state machine and of SCD2 / as-of over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import states as S
from ..operators.dims import scd2_versions
from ..operators.fact import asof_join
from ..sources import driver
from .oracle_etl import with_etl

EVENT_CASE = """CASE event_type WHEN 'signup' THEN 'create' WHEN 'view' THEN 'confirm'
  WHEN 'click' THEN 'complete' WHEN 'purchase' THEN 'invoice' WHEN 'error' THEN 'cancel' END"""

def _values(transitions) -> str:
    return "(VALUES " + ", ".join(str(t) for t in transitions) + ") AS tr(state, ev, nxt)"


TRANSITIONS_VALUES = _values(S.TRANSITIONS)

# requests that can be taken up again: every state but the initial one is on a cycle
REOPENING = (
    ("initial", "create", "booked"), ("booked", "confirm", "confirmed"), ("confirmed", "cancel", "booked"),
    ("booked", "cancel", "cancelled"), ("cancelled", "create", "booked"), ("confirmed", "complete", "completed"),
    ("completed", "invoice", "invoiced"), ("invoiced", "create", "booked"), ("invoiced", "invoice", "invoiced"),
)


def state_final(spark, sf_dir):
    return S.run_machine(driver.request_events(spark, sf_dir), "user_id", ["ts", "event_id"], "event")


def state_final_cyclic(spark, sf_dir):
    """M2 over a table with cycles and without terminal states."""
    return S.run_machine(driver.request_events(spark, sf_dir), "user_id", ["ts", "event_id"], "event", REOPENING, terminal=())


CANCEL_FROM = ("confirmed", "booked", "completed", "invoiced", "initial", "elsewhere", None)


def state_trajectories(spark, sf_dir):
    """M4: each request's status with a state that it is said to be cancelled from."""
    named = F.try_element_at(F.array(*[F.lit(x) for x in CANCEL_FROM]), (F.col("id") % len(CANCEL_FROM) + 1).cast("int"))
    r = driver.requests_entity(spark, sf_dir).select("status", named.alias("cancel_from"))
    groups = r.groupBy("status", "cancel_from").agg(F.count(F.lit(1)).alias("n_requests"))
    return groups.select("*", *[c.alias(n) for n, c in S.trajectory_columns(F.col("status"), F.col("cancel_from")).items()])


def state_step_matrix(spark, sf_dir):
    return S.step_matrix(driver.request_events(spark, sf_dir), "user_id", ["ts", "event_id"], "event")


def state_reachable(spark, sf_dir):
    r = driver.requests_entity(spark, sf_dir)
    return (r.groupBy("status").agg(F.count(F.lit(1)).alias("n_requests"))
             .withColumn("reachable", S.reachable_flag("status")))


def scd2_signup_versions(spark, sf_dir):
    v = scd2_versions(driver.signups(spark, sf_dir), persona="user_id", ts="ts", tiebreak="event_id")
    return v.select("event_id", "user_id", "valid_from", "valid_to", "is_current")


def asof_purchase(spark, sf_dir):
    v = scd2_versions(driver.signups(spark, sf_dir), persona="user_id", ts="ts", tiebreak="event_id")
    v = v.select("user_id", "valid_from", "valid_to", F.col("event_id").alias("signup_event_id"))
    p = driver.purchases(spark, sf_dir)
    return asof_join(p, v, "user_id", "ts", "user_id", take=["signup_event_id"],
                     version_order=["signup_event_id"])


def _final_sql(transitions, terminal: str) -> str:
    return f"""
WITH RECURSIVE ev AS (
  SELECT user_id, ts, event_id, {EVENT_CASE} AS ev,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events
), tr AS (SELECT * FROM {_values(transitions)}),
run AS (
  SELECT user_id, CAST(0 AS BIGINT) AS rn, 'initial' AS state, CAST(NULL AS BOOLEAN) AS accepted
  FROM (SELECT DISTINCT user_id FROM ev) u
  UNION ALL
  SELECT e.user_id, e.rn, COALESCE(t.nxt, r.state), t.nxt IS NOT NULL
  FROM run r JOIN ev e ON e.user_id = r.user_id AND e.rn = r.rn + 1
  LEFT JOIN tr t ON t.state = r.state AND t.ev = e.ev
), per AS (
  SELECT r.user_id, arg_max(r.state, r.rn) AS final_state,
         COUNT(*) FILTER (WHERE r.rn > 0) AS n_events,
         COUNT(*) FILTER (WHERE r.accepted) AS n_accepted,
         MIN(r.rn) FILTER (WHERE r.rn > 0 AND NOT r.accepted) AS first_bad
  FROM run r GROUP BY r.user_id
)
SELECT p.user_id, p.final_state, {terminal} AS is_terminal,
       p.n_events, p.n_accepted, e.ts AS first_refused_ts, e.event_id AS first_refused_event_id
FROM per p LEFT JOIN ev e ON e.user_id = p.user_id AND e.rn = p.first_bad"""


SQL = {
    "state_final": _final_sql(S.TRANSITIONS, "p.final_state IN ('invoiced', 'cancelled')"),
    "state_final_cyclic": _final_sql(REOPENING, "FALSE"),
    "state_trajectories": with_etl(f"""
SELECT e.status, cancel_from, n_requests, entered_from, CAST(n + 1 AS INT) AS n_steps, n IS NOT NULL AS valid
FROM (SELECT g.*, CASE WHEN EXISTS (SELECT 1 FROM {TRANSITIONS_VALUES} WHERE nxt = status AND state = cancel_from) THEN cancel_from
             WHEN EXISTS (SELECT 1 FROM {TRANSITIONS_VALUES} WHERE nxt = status AND state = 'booked') THEN 'booked'
             ELSE (SELECT MIN(state) FROM {TRANSITIONS_VALUES} WHERE nxt = status) END AS entered_from
      FROM (SELECT status, CASE id % 7 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'booked' WHEN 2 THEN 'completed'
                   WHEN 3 THEN 'invoiced' WHEN 4 THEN 'initial' WHEN 5 THEN 'elsewhere' END AS cancel_from,
                   COUNT(*) AS n_requests FROM requests GROUP BY ALL) g) e
LEFT JOIN (WITH RECURSIVE walk AS (
    SELECT 'initial' AS state, 0 AS n UNION ALL
    SELECT tr.nxt, n + 1 FROM walk JOIN {TRANSITIONS_VALUES} ON tr.state = walk.state)
  SELECT state, MIN(n) AS n FROM walk GROUP BY state) steps ON steps.state = entered_from"""),
    "state_step_matrix": f"""
WITH ev AS (
  SELECT {EVENT_CASE} AS event,
         LAG({EVENT_CASE}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_event
  FROM events
), tr AS (SELECT * FROM {TRANSITIONS_VALUES}),
allowed AS (
  SELECT DISTINCT a.ev AS a, b.ev AS b FROM tr a JOIN tr b ON b.state = a.nxt
  UNION SELECT NULL, ev FROM tr WHERE state = 'initial'
)
SELECT ev.prev_event, ev.event, COUNT(*) AS n_steps,
       COALESCE(BOOL_OR(al.b IS NOT NULL), FALSE) AS allowed
FROM ev LEFT JOIN allowed al ON ev.prev_event IS NOT DISTINCT FROM al.a AND ev.event = al.b
GROUP BY ev.prev_event, ev.event""",
    "state_reachable": f"""
WITH requests AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'cancelled'
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'invoiced'
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'completed'
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'confirmed'
            WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'booked' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT status, COUNT(*) AS n_requests,
       COALESCE(status IN ('booked', 'cancelled', 'completed', 'confirmed', 'invoiced'), FALSE) AS reachable
FROM requests GROUP BY status""",
    "scd2_signup_versions": """
SELECT event_id, user_id, ts AS valid_from,
       LEAD(ts) OVER w AS valid_to, CASE WHEN LEAD(1) OVER w IS NULL THEN 1 ELSE 0 END AS is_current
FROM events WHERE event_type = 'signup'
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "asof_purchase": """
WITH v AS (
  SELECT event_id AS signup_event_id, user_id, ts AS valid_from,
         LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events WHERE event_type = 'signup'
)
SELECT p.event_id, p.user_id, p.ts, p.value, v.signup_event_id
FROM events p LEFT JOIN v ON v.user_id = p.user_id AND v.valid_from <= p.ts
  AND (v.valid_to IS NULL OR p.ts < v.valid_to)
WHERE p.event_type = 'purchase'""",
}

BUILDERS = {
    "state_final": state_final,
    "state_final_cyclic": state_final_cyclic,
    "state_trajectories": state_trajectories,
    "state_step_matrix": state_step_matrix,
    "state_reachable": state_reachable,
    "scd2_signup_versions": scd2_signup_versions,
    "asof_purchase": asof_purchase,
}


def entries() -> dict:
    return {name: (b, SQL.get(name)) for name, b in BUILDERS.items()}


# ------------------------------------------------------------ rules over labels

LANGS = ("de", "en", "es", "fr")


def rules_labels(spark, sf_dir):
    """The rule engine over ``labels``: duplicate doc id, 0/1 flags, and the
    document must exist with an allowed language (a parent rule)."""
    from ..operators import validation as V
    labels = driver.table(spark, sf_dir, "labels")
    docs = driver.table(spark, sf_dir, "documents").select("doc_id", "lang")
    docs_ok = docs.where(F.coalesce(F.col("lang").isin(list(LANGS)), F.lit(False))) \
                  .select(F.col("doc_id").alias("_d")).distinct().withColumn("_doc_ok", F.lit(True))
    x = V.flag_duplicate_keys(labels, "doc_id", "_dup")
    x = x.join(docs_ok, x["doc_id"] == docs_ok["_d"], "left").drop("_d")
    rules = [
        V.Rule("duplicate_id", F.col("_dup")),
        V.Rule("document_not_found", F.col("_doc_ok").isNull()),
        V.Rule("quality_not_0_1", V.not_in_set("quality", (0, 1))),
        V.Rule("toxic_not_0_1", V.not_in_set("toxic", (0, 1))),
        V.Rule("missing_key", V.is_missing("doc_id")),
    ]
    checked = V.apply_rules(x, rules).drop("_dup", "_doc_ok")
    return checked.select("doc_id", "quality", "toxic", "reason")


SQL["rules_labels"] = """
SELECT doc_id, quality, toxic, CASE
  WHEN COUNT(*) OVER (PARTITION BY doc_id) > 1 THEN 'duplicate_id'
  WHEN d.d IS NULL THEN 'document_not_found'
  WHEN NOT COALESCE(quality IN (0, 1), FALSE) THEN 'quality_not_0_1'
  WHEN NOT COALESCE(toxic IN (0, 1), FALSE) THEN 'toxic_not_0_1'
  WHEN doc_id IS NULL THEN 'missing_key'
END AS reason
FROM labels l LEFT JOIN (SELECT DISTINCT doc_id AS d FROM documents
                         WHERE COALESCE(lang IN ('de', 'en', 'es', 'fr'), FALSE)) d ON l.doc_id = d.d"""
BUILDERS["rules_labels"] = rules_labels
