"""Interval state: any split of the log gives the intervals of one run."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ratify.operators.changelog import membership_changes, membership_events, membership_intervals, order_events
from ratify.operators.interval_state import IntervalState, LateEvents
from ratify.sources import schemas as S

from tests import fixtures as FX


@pytest.fixture(scope="module")
def log():
    rng = random.Random(4)
    rows, held = [], {}
    for _ in range(160):
        client = rng.choice([1, 1, 1, 2, 3, None])
        old = held.get(client, set())
        new = {str(rng.choice([10, 20, 30, 40])) for _ in range(rng.randint(0, 3))}
        when = dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 400), hours=rng.choice([0, 0, 8]))
        rows.append((client, rng.choice([586, 586, 586, 587]), when, ";".join(sorted(old)), " , ".join(sorted(new))))
        held[client] = new
    return sorted(rows, key=lambda r: r[2]) + [(1, 586, None, "", "10"), (1, 586, None, "10", "")]


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(FX.USERS, S.USERS)


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def _state(spark):
    return IntervalState(spark, f"{tempfile.mkdtemp(prefix='ratify-state-')}/intervals")


def test_slices_in_time_order(spark, log, users):
    state, frame = _state(spark), lambda rows: spark.createDataFrame(rows, S.PARAM_LOG)
    timed = [r for r in log if r[2]]
    days = sorted({r[2].date() for r in timed})
    marks = [days[0], days[30], days[31], days[90], days[-1] + dt.timedelta(days=1)]
    first = [r for r in log if not r[2]]
    for low, high in zip(marks, marks[1:]):  # noqa: B905, RUF007
        state.apply(frame(first + [r for r in timed if low <= r[2].date() < high]))
        first = []
    assert state.latest() == 4
    assert _rows(state.intervals(users)) == _rows(membership_intervals(frame(log), users))
    whole = order_events(membership_events(membership_changes(frame(log))))
    assert _rows(state.ordered().select(whole.columns)) == _rows(whole)


def test_late_slices_are_refused_or_replayed(spark, log, users):
    state, frame = _state(spark), lambda rows: spark.createDataFrame(rows, S.PARAM_LOG)
    rng = random.Random(8)
    mixed = log[:]
    rng.shuffle(mixed)
    parts = [mixed[:50], mixed[50:60], mixed[60:130], mixed[130:]]
    state.apply(frame(parts[0]))
    before = _rows(state.ordered())
    with pytest.raises(LateEvents):
        state.apply(frame(parts[1]))
    assert state.latest() == 1 and _rows(state.ordered()) == before
    for part in parts[1:]:
        state.apply(frame(part), late="replay")
    assert _rows(state.intervals(users)) == _rows(membership_intervals(frame(log), users))
    with pytest.raises(ValueError):
        state.apply(frame(parts[1]), late="drop")


def test_a_new_session_reads_the_state_and_empty_slices_change_nothing(spark, log, users):
    state, frame = _state(spark), lambda rows: spark.createDataFrame(rows, S.PARAM_LOG)
    with pytest.raises(ValueError):
        state.ordered()
    state.apply(frame([]))
    assert _rows(state.ordered()) == []
    state.apply(frame(log[:80]))
    again = IntervalState(spark.newSession(), state.path)
    again.apply(frame([]))
    again.apply(frame([r for r in log[:80] if r[0] == 99]))
    assert again.latest() == 4
    assert _rows(again.intervals(users)) == _rows(membership_intervals(frame(log[:80]), users))


def test_the_log_is_scanned_once(spark, log):
    path = f"{tempfile.mkdtemp(prefix='ratify-log-')}/log"
    spark.createDataFrame(log, S.PARAM_LOG).write.parquet(path)
    ordered = order_events(membership_events(membership_changes(spark.read.parquet(path))))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ordered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan  # once for ADD, once for REMOVE events
    assert F is not None
