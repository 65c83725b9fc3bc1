"""Request state machine (M1-M6).

The transition table is a handful of rows fixed by the model. An event is a
function from state to state (a refused one keeps the state), and such
functions compose: a run of events is a small array with, for every state it
may start in, the state it ends in, how many events were accepted and the
first that was refused. Event histories are range-partitioned on (entity,
order) once, so a very long history lies in several partitions; each
partition composes its runs to one array each, and only these are brought
together per entity. No history is gathered into one task or row, and tables
with cycles are like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import DEFAULT_CANCEL_FROM, INITIAL_STATE, TERMINAL_STATES, TRANSITIONS
from .segmented import lag_in_group

Transitions = Sequence[tuple[str, str, str]]


def transition_table(spark: SparkSession, transitions: Transitions = TRANSITIONS) -> DataFrame:
    """M1 as a DataFrame ``state, event, next_state``."""
    return spark.createDataFrame(list(transitions), "state string, event string, next_state string")


def is_terminal(state: Column | str, terminal: Sequence[str] = TERMINAL_STATES) -> Column:
    """M3."""
    c = F.col(state) if isinstance(state, str) else state
    return F.coalesce(c.isin(list(terminal)), F.lit(False))


def reachable_states(transitions: Transitions = TRANSITIONS, initial: str = INITIAL_STATE) -> set[str]:
    """M4: states reachable from ``initial`` (computed on the driver from the
    table itself, a few rows)."""
    seen, todo = set(), [initial]
    while todo:
        s = todo.pop()
        for a, _, b in transitions:
            if a == s and b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


def _steps_to(transitions: Transitions, initial: str) -> dict[str, int]:
    """Steps of the shortest path from ``initial`` to each reachable state."""
    steps, level = {initial: 0}, [initial]
    while level:
        level = sorted({b for a, _, b in transitions if a in level and b not in steps})
        steps |= {b: max(steps.values()) + 1 for b in level}
    return steps


def _entered_from(target: str, cancel_from: str | None, transitions: Transitions, default_from: str) -> str | None:
    """The state that the path to ``target`` leaves by its last step."""
    before = [a for a, _, b in transitions if b == target]
    for state in (cancel_from, default_from):
        if state in before:
            return state
    return before[0] if before else None


def validate_trajectory(target: str | None, cancel_from: str | None = None, transitions: Transitions = TRANSITIONS,
                        initial: str = INITIAL_STATE, default_from: str = DEFAULT_CANCEL_FROM) -> bool:
    """M4: a path of the table leads from ``initial`` to ``target``. Where the
    target can be entered from several states, ``cancel_from`` chooses one; any
    other value means ``default_from``."""
    steps = _steps_to(transitions, initial)
    return target != initial and target in steps and _entered_from(target, cancel_from, transitions, default_from) in steps


def trajectory_columns(status: Column, cancel_from: Column, transitions: Transitions = TRANSITIONS,
                       initial: str = INITIAL_STATE, default_from: str = DEFAULT_CANCEL_FROM) -> dict[str, Column]:
    """M4 as columns: ``entered_from``, ``n_steps`` of the shortest path that
    enters the status from there, and ``valid``. The table has a few states."""
    steps, entered, length = _steps_to(transitions, initial), F.lit(None).cast("string"), F.lit(None).cast("int")
    for target in sorted({b for _, _, b in transitions}):
        for source in sorted({a for a, _, b in transitions if b == target}):
            here = (status == target) & (cancel_from == source)
            entered = F.when(here, source).otherwise(entered)
        usual = _entered_from(target, None, transitions, default_from)
        chosen = cancel_from.isin([a for a, _, b in transitions if b == target])
        entered = F.when((status == target) & ~F.coalesce(chosen, F.lit(False)), usual).otherwise(entered)
    for state, n in steps.items():
        length = F.when(entered == state, n + 1).otherwise(length)
    valid = F.coalesce((status != initial) & length.isNotNull(), F.lit(False))
    return {"entered_from": entered, "n_steps": F.when(valid, length), "valid": valid}


def reachable_flag(status: Column | str, transitions: Transitions = TRANSITIONS) -> Column:
    """M4 as a column: the status is reachable from the initial state."""
    c = F.col(status) if isinstance(status, str) else status
    return F.coalesce(c.isin(sorted(reachable_states(transitions))), F.lit(False))


def filter_unreachable(requests: DataFrame, status: str = "status",
                       transitions: Transitions = TRANSITIONS) -> tuple[DataFrame, DataFrame]:
    """M5: (reachable rows, quarantine rows ``table, key, reason``)."""
    ok = reachable_flag(status, transitions)
    return (requests.where(ok),
            requests.where(~ok).select(F.lit("requests").alias("table"), F.col("id").cast("string").alias("key"),
                                       F.lit("unreachable_state").alias("reason")))


def _composed_runs(events: DataFrame, order_cols: Sequence[str], next_state: list[list[int]]) -> DataFrame:
    """``_e, first, n, ends, accepted, refused`` of each run of one entity's
    events in a batch of ``events`` (``_e``, the order columns, ``_code``):
    by start state, the state at its end, the number of accepted events and
    the order columns of the first refused one. Neighbouring runs are composed
    in pairs until each is one, in whole arrays."""
    k = len(next_state[0])
    width = len(order_cols)
    entity = events.schema["_e"].dataType
    order = T.StructType([events.schema[c] for c in order_cols])
    schema = T.StructType([T.StructField("_e", entity), T.StructField("first", order), T.StructField("n", T.LongType()),
                           T.StructField("ends", T.ArrayType(T.IntegerType())),
                           T.StructField("accepted", T.ArrayType(T.LongType())),
                           T.StructField("refused", T.ArrayType(order))])
    names = list(order_cols)

    def compose(end, accepted, refused, run):
        while len(run) and (run[1:] == run[:-1]).any():
            start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            within = np.arange(len(run)) - np.repeat(start, np.diff(np.r_[start, len(run)]))
            left = np.flatnonzero(within % 2 == 0)
            paired = (left + 1 < len(run)) & (np.r_[run, -1][left + 1] == run[left])
            a, b = left[paired], left[paired] + 1
            then = end[a]  # states in which the second half starts
            end[a], accepted[a] = np.take_along_axis(end[b], then, 1), accepted[a] + np.take_along_axis(accepted[b], then, 1)
            refused[a] = np.minimum(refused[a], np.take_along_axis(refused[b], then, 1))
            end, accepted, refused, run = end[left], accepted[left], refused[left], run[left]
        return end, accepted, refused

    def run_batches(batches):
        table = np.array(next_state)  # by event code, the last one for events that no state accepts
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            e = b.column(0)
            other = pc.fill_null(pc.not_equal(e.slice(1), e.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
            null = e.is_null().to_numpy(zero_copy_only=False)
            new = np.r_[True, other & ~(null[1:] & null[:-1])]
            run = np.cumsum(new) - 1
            code = b.column(width + 1).to_numpy(zero_copy_only=False)
            ok = table[code] >= 0
            end = np.where(ok, table[code], np.arange(k))
            refused = np.where(ok, n, np.arange(n)[:, None])
            end, accepted, refused = compose(end, ok.astype(np.int64), refused, run)
            first = np.flatnonzero(new)
            rows = len(first)
            order_of = [b.column(i + 1) for i in range(width)]
            none = refused.ravel() == n
            at = pa.array(np.where(none, 0, refused.ravel()))
            offsets = pa.array(np.arange(rows + 1) * k, pa.int32())
            told = pa.StructArray.from_arrays([c.take(at) for c in order_of], names, mask=pa.array(none))
            firsts = pa.array(first)
            yield pa.RecordBatch.from_arrays([
                e.take(firsts), pa.StructArray.from_arrays([c.take(firsts) for c in order_of], names),
                pa.array(np.diff(np.r_[first, n])), pa.ListArray.from_arrays(offsets, pa.array(end.ravel().astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(accepted.ravel())), pa.ListArray.from_arrays(offsets, told),
            ], ["_e", "first", "n", "ends", "accepted", "refused"])

    return events.mapInArrow(run_batches, schema)


def run_machine(events: DataFrame, entity: str, order_cols: Sequence[str], event_col: str,
                transitions: Transitions = TRANSITIONS, initial: str = INITIAL_STATE,
                terminal: Sequence[str] = TERMINAL_STATES) -> DataFrame:
    """M2 over event histories: per entity the final state (a refused event
    keeps the state), the number of events and of accepted events, and the
    first refused event (its order columns), plus M3 on the final state.

    The events are moved once. Per entity there is then one row for each
    Arrow batch that its history lies in."""
    states = [initial] + sorted({s for a, _, b in transitions for s in (a, b)} - {initial})
    names = sorted({e for _, e, _ in transitions})
    follows = {(a, e): states.index(b) for a, e, b in transitions}
    next_state = [[follows.get((s, e), -1) for s in states] for e in names] + [[-1] * len(states)]
    code = F.lit(len(names))
    for i, e in enumerate(names):
        code = F.when(F.col(event_col) == e, i).otherwise(code)
    keys = [F.col("_e"), *[F.col(c) for c in order_cols]]
    n = max(int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = (events.select(F.col(entity).alias("_e"), *order_cols, code.alias("_code"))
               .repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    runs = _composed_runs(ordered, order_cols, next_state)
    refused_type = runs.schema["refused"].dataType.elementType

    def then(acc: Column, x: Column) -> Column:
        by_state = lambda c: F.element_at(x[c], acc["state"] + 1)
        return F.struct(by_state("ends").alias("state"), (acc["n"] + x["n"]).alias("n"),
                        (acc["accepted"] + by_state("accepted")).alias("accepted"),
                        F.coalesce(acc["refused"], by_state("refused")).alias("refused"))

    zero = F.lit(0).cast("bigint")
    start = F.struct(F.lit(0).alias("state"), zero.alias("n"), zero.alias("accepted"),
                     F.lit(None).cast(refused_type).alias("refused"))
    parts = F.sort_array(F.collect_list(F.struct("first", "n", "ends", "accepted", "refused")))
    done = runs.groupBy("_e").agg(F.aggregate(parts, start, then).alias("r"))
    final = F.element_at(F.array(*[F.lit(s) for s in states]), F.col("r.state") + 1)
    return done.select(
        F.col("_e").alias(entity), final.alias("final_state"), is_terminal(final, terminal).alias("is_terminal"),
        F.col("r.n").alias("n_events"), F.col("r.accepted").alias("n_accepted"),
        *[F.col(f"r.refused.{c}").alias(f"first_refused_{c}") for c in order_cols])


def allowed_event_pairs(transitions: Transitions = TRANSITIONS, initial: str = INITIAL_STATE) -> list[tuple]:
    """Event pairs (e1, e2) such that some state reached by e1 accepts e2, and
    (None, e) for events accepted from the initial state."""
    targets: dict[str, set[str]] = {}
    for _, e, b in transitions:
        targets.setdefault(e, set()).add(b)
    out = [(None, e) for a, e, _ in transitions if a == initial]
    for e1, ts in targets.items():
        for a, e2, _ in transitions:
            if a in ts:
                out.append((e1, e2))
    return sorted(set(out), key=lambda t: (t[0] or "", t[1]))


def step_matrix(events: DataFrame, entity: str, order_cols: Sequence[str], event_col: str,
                transitions: Transitions = TRANSITIONS, initial: str = INITIAL_STATE) -> DataFrame:
    """M6: consecutive event pairs per entity, counted, with whether the step
    is allowed by the table. The previous event comes from a segmented lag,
    so a very long history is split across tasks."""
    spark = events.sparkSession
    prev = lag_in_group(events.select(entity, *order_cols, event_col), [entity], list(order_cols),
                        event_col, "prev_event")
    pairs = (prev.groupBy("prev_event", F.col(event_col).alias("event"))
                 .agg(F.count(F.lit(1)).alias("n_steps")))
    allowed = spark.createDataFrame(allowed_event_pairs(transitions, initial), "a string, b string") \
                   .withColumn("_ok", F.lit(True))
    j = pairs.join(F.broadcast(allowed),  # derived from the fixed table: at most events² rows
                   pairs["prev_event"].eqNullSafe(allowed["a"]) & (pairs["event"] == allowed["b"]), "left")
    return j.select("prev_event", "event", "n_steps", F.coalesce(F.col("_ok"), F.lit(False)).alias("allowed"))
