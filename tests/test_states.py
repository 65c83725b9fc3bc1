import datetime as dt

import pytest

from dimstar.operators import states as S

T = dt.datetime


@pytest.mark.parametrize("target,ok", [("booked", True), ("confirmed", True), ("completed", True),
                                       ("invoiced", True), ("cancelled", True), ("initial", False),
                                       ("open", False), (None, False)])
def test_reachable_targets(target, ok):
    assert S.validate_trajectory(target) is ok
    assert (target in S.reachable_states()) is ok


def test_cancel_from_confirmed():
    assert S.validate_trajectory("cancelled", cancel_from="confirmed")


def _events(spark, seqs):
    rows = []
    eid = 0
    for entity, events in seqs.items():
        for i, e in enumerate(events):
            rows.append((entity, T(2025, 1, 1, 0, i), eid, e))
            eid += 1
    return spark.createDataFrame(rows, "entity string, ts timestamp_ntz, event_id int, event string")


def test_runs_keep_state_on_refused_event(spark):
    ev = _events(spark, {
        "a": ["create", "confirm", "cancel"],
        "b": ["create", "complete"],
        "c": ["create", "cancel", "confirm"],
        "d": ["confirm", "create", "confirm", "complete", "invoice", "cancel"],
    })
    out = {r.entity: r for r in S.run_machine(ev, "entity", ["ts", "event_id"], "event").collect()}
    assert (out["a"].final_state, out["a"].is_terminal, out["a"].first_refused_event_id) == ("cancelled", True, None)
    assert (out["b"].final_state, out["b"].is_terminal, out["b"].first_refused_event_id) == ("booked", False, 4)
    assert (out["c"].final_state, out["c"].first_refused_event_id) == ("cancelled", 7)
    assert (out["d"].final_state, out["d"].n_events, out["d"].n_accepted) == ("invoiced", 6, 4)
    assert out["d"].first_refused_event_id == 8


def test_step_matrix(spark):
    ev = _events(spark, {"a": ["create", "confirm", "cancel"], "b": ["create", "complete"]})
    got = {(r.prev_event, r.event): (r.n_steps, r.allowed)
           for r in S.step_matrix(ev, "entity", ["ts", "event_id"], "event").collect()}
    assert got == {(None, "create"): (2, True), ("create", "confirm"): (1, True),
                   ("confirm", "cancel"): (1, True), ("create", "complete"): (1, False)}


def test_cancel_from_is_the_reference_rule():
    """'confirmed' goes through confirmed, any other value cancels from booked."""
    for other in ("completed", "invoiced", "initial", "booked", "elsewhere", "cancelled", None):
        assert S.validate_trajectory("cancelled", other)
        assert S._entered_from("cancelled", other, S.TRANSITIONS, "booked") == "booked"
    assert S._entered_from("cancelled", "confirmed", S.TRANSITIONS, "booked") == "confirmed"
    lost = [("initial", "go", "a"), ("b", "stop", "end")]
    assert not S.validate_trajectory("end", transitions=lost) and S.validate_trajectory("a", transitions=lost)


CYCLIC = [("initial", "create", "a"), ("a", "confirm", "b"), ("b", "cancel", "a"), ("b", "create", "b"), ("b", "invoice", "initial")]


def test_cyclic_table(spark):
    ev = _events(spark, {"a": ["create", "confirm", "cancel", "confirm", "invoice", "cancel", "create"], "b": ["confirm", "confirm"]})
    out = {r.entity: r for r in S.run_machine(ev, "entity", ["ts", "event_id"], "event", CYCLIC, terminal=()).collect()}
    assert (out["a"].final_state, out["a"].n_accepted, out["a"].first_refused_event_id) == ("a", 6, 5)
    assert (out["b"].final_state, out["b"].n_accepted, out["b"].first_refused_event_id) == ("initial", 0, 7)


def test_runs_move_the_events_once(spark):
    ev = _events(spark, {"a": ["create"], "b": ["confirm"]})
    plan = S.run_machine(ev, "entity", ["ts", "event_id"], "event")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("table", [S.TRANSITIONS, CYCLIC])
def test_runs_across_batches_and_partitions(spark, batch, table):
    """A hot entity with a third of the events, entities and events that are NULL."""
    import random

    rnd = random.Random(batch)
    names = ["create", "confirm", "complete", "invoice", "cancel", "noise", None]
    rows = [(rnd.choice(["hot", "hot", "x", "y", "z", None]), T(2025, 1, 1) + dt.timedelta(seconds=rnd.randrange(10**6)), i, rnd.choice(names))
            for i in range(700)]
    df = spark.createDataFrame(rows, "entity string, ts timestamp_ntz, event_id int, event string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {r.entity: (r.final_state, r.n_accepted, r.first_refused_event_id, r.n_events)
               for r in S.run_machine(df, "entity", ["ts", "event_id"], "event", table).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ordered = {}
    for ent, _, i, ev in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        ordered.setdefault(ent, []).append((i, ev))
    assert got == {ent: (*_fold(evs, table), len(evs)) for ent, evs in ordered.items()}


def test_empty_history(spark):
    assert S.run_machine(_events(spark, {"a": ["create"]}).limit(0), "entity", ["ts"], "event").collect() == []


def _fold(events, transitions=S.TRANSITIONS):
    table = {(a, e): b for a, e, b in transitions}
    state, accepted, first_bad = "initial", 0, None
    for eid, ev in events:
        nxt = table.get((state, ev))
        if nxt is None:
            if first_bad is None:
                first_bad = eid
        else:
            state, accepted = nxt, accepted + 1
    return state, accepted, first_bad


def test_runs_equal_sequential_fold_random(spark):
    import random

    rnd = random.Random(7)
    names = ["create", "confirm", "complete", "invoice", "cancel", "noise"]
    rows, eid = [], 0
    for ent in range(60):
        n = 300 if ent == 0 else rnd.randint(0, 12)  # one long history
        for i in range(n):
            rows.append((f"e{ent}", T(2025, 1, 1) + dt.timedelta(seconds=i * 7 + rnd.randint(0, 3)), eid,
                         rnd.choice(names)))
            eid += 1
    df = spark.createDataFrame(rows, "entity string, ts timestamp_ntz, event_id int, event string")
    got = {r.entity: (r.final_state, r.n_accepted, r.first_refused_event_id, r.n_events)
           for r in S.run_machine(df, "entity", ["ts", "event_id"], "event").collect()}
    ordered = {}
    for ent, ts, i, ev in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        ordered.setdefault(ent, []).append((i, ev))
    exp = {ent: (*_fold(evs), len(evs)) for ent, evs in ordered.items()}
    assert got == exp


def test_step_matrix_random(spark):
    import random

    rnd = random.Random(23)
    names = ["create", "confirm", "complete", "invoice", "cancel", "noise"]
    rows = []
    for ent in range(40):
        for i in range(400 if ent == 0 else rnd.randint(1, 15)):  # one long history
            rows.append((f"e{ent}", T(2025, 1, 1) + dt.timedelta(seconds=i), len(rows), rnd.choice(names)))
    df = spark.createDataFrame(rows, "entity string, ts timestamp_ntz, event_id int, event string")
    got = {(r.prev_event, r.event): (r.n_steps, r.allowed)
           for r in S.step_matrix(df, "entity", ["ts", "event_id"], "event").collect()}
    allowed = set(S.allowed_event_pairs())
    exp, prev = {}, {}
    for ent, _ts, _i, ev in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        key = (prev.get(ent), ev)
        n, _ = exp.get(key, (0, False))
        exp[key] = (n + 1, key in allowed)
        prev[ent] = ev
    assert got == exp
