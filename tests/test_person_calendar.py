"""Working time by person: Saturdays, a change of class in the middle, weeks without approvals, gaps and open ends."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratify.operators.calendar import build_calendar, business_time, worked_days
from ratify.operators.person_calendar import CLASSES, PersonCalendar, WorkClass, roster_assignments
from ratify.sources import schemas as S

DAY = dt.date
ASSIGNED = "web_user_name string, valid_from date, valid_to date, calendar_class string"
CLASS_DAYS = CLASSES | {"late": WorkClass(day_start=600, day_end=1200)}
ROWS = [("bruno", None, None, "saturdays"), ("carla", None, DAY(2025, 3, 12), "saturdays"), ("carla", DAY(2025, 3, 20), None, "late"),
        ("dora", DAY(2025, 3, 5), DAY(2025, 3, 5), "late"), ("dora", DAY(2025, 3, 6), DAY(2025, 3, 7), "saturdays"),
        (None, None, None, "late"), ("eva", DAY(2025, 3, 9), DAY(2025, 3, 8), "late")]


@pytest.fixture(scope="module")
def calendar(spark):
    free = spark.createDataFrame([(DAY(2025, 3, 15), "Holiday"), (DAY(2025, 3, 17), "Bridge")], S.HOLIDAYS)
    return build_calendar(spark, DAY(2025, 3, 1), DAY(2025, 3, 31), free)


def _class_on(person, day):
    for name, first, last, label in ROWS:
        if name is not None and name == person and (first or DAY.min) <= day <= (last or DAY.max):
            return CLASS_DAYS[label]
    return CLASS_DAYS["weekdays"]


def _works(person, day):
    return day.weekday() <= _class_on(person, day).last_weekday and day != DAY(2025, 3, 15)


def _minutes(person, start, end):
    """Minute by minute."""
    if end < start:
        return -_minutes(person, end, start)
    total, at = 0, start
    while at < end:
        c = _class_on(person, at.date())
        total += _works(person, at.date()) and c.day_start <= at.hour * 60 + at.minute < c.day_end
        at += dt.timedelta(minutes=1)
    return total


def test_minutes_equal_a_count_minute_by_minute(spark, calendar):
    moments = [dt.datetime(2025, 3, d, h, 30) for d, h in ((3, 7), (5, 11), (8, 9), (12, 19), (15, 12), (19, 17), (20, 9), (29, 20))]
    rows = [(f"{p}{i}{j}", p, a, b) for p in ("ana", "bruno", "carla", "dora", "eva", None)
            for i, a in enumerate(moments) for j, b in enumerate(moments) if (i + j) % 3 == 0]
    rows += [("out", "ana", dt.datetime(2025, 2, 27), moments[0]), ("after", "ana", moments[0], dt.datetime(2025, 4, 1, 9)),
             ("none", "ana", None, moments[0])]
    df = spark.createDataFrame(rows, "id string, who string, a timestamp, b timestamp")
    person = PersonCalendar(calendar, spark.createDataFrame(ROWS, ASSIGNED), CLASS_DAYS)
    got = {r.id: r.sla_minutes for r in person.business_time(df, "a", "b", "who").collect()}
    want = {i: _minutes(p, a, b) for i, p, a, b in rows[:-3]} | {"out": None, "after": None, "none": None}
    assert got == want and len(got) == len(rows)


def test_days_between_any_two_dates(spark, calendar):
    spans = [(p, DAY(2025, 3, a), DAY(2025, 3, b)) for p in ("ana", "bruno", "carla", "dora") for a in (1, 5, 10) for b in (6, 13, 21, 31)]
    spans.append(("carla", DAY(2024, 1, 1), DAY(2026, 1, 1)))  # the calendar has March alone
    person = PersonCalendar(calendar, spark.createDataFrame(ROWS, ASSIGNED), CLASS_DAYS)
    got = person.worked_days(spark.createDataFrame(spans, "who string, a date, b date"), "a", "b", "who").collect()
    march = [DAY(2025, 3, d) for d in range(1, 32)]
    for r in got:
        sign = 1 if r.a <= r.b else -1
        lo, hi = min(r.a, r.b), max(r.a, r.b)
        assert r.worked_days == sign * sum(lo <= d < hi and _works(r.who, d) for d in march), r


def test_weeks_without_approvals_are_there(spark, calendar):
    orders = spark.createDataFrame([("carla", DAY(2025, 3, 4)), ("carla", DAY(2025, 3, 28)), ("ana", DAY(2025, 3, 11))],
                                   "_aprovador string, data_aprovacao date")
    person = PersonCalendar(calendar, spark.createDataFrame(ROWS, ASSIGNED), CLASS_DAYS)
    got = {(r.YearWeek, r._aprovador): r.worked_days for r in person.worked_weeks(orders).collect()}
    assert got == {(202510, "carla"): 6, (202511, "carla"): 5, (202512, "carla"): 5, (202513, "carla"): 5, (202511, "ana"): 5}


def test_one_class_for_all_days_is_the_plain_calendar(spark, calendar):
    roster = spark.createDataFrame([("bruno",), ("bruno",), (None,)], S.ROSTER)
    person = PersonCalendar(calendar, roster_assignments(roster))
    orders = spark.createDataFrame([("bruno", DAY(2025, 3, 4)), ("ana", DAY(2025, 3, 11))], "_aprovador string, data_aprovacao date")
    dated = orders.join(calendar, F.col("data_aprovacao") == F.col("ReferenceDate"))
    plain = {(r.YearWeek, r._aprovador): r.worked_days for r in worked_days(dated, calendar, roster).collect()}
    assert {(r.YearWeek, r._aprovador): r.worked_days for r in person.worked_weeks(orders).collect()} == plain
    times = spark.createDataFrame([("ana", dt.datetime(2025, 3, 6, 9), dt.datetime(2025, 3, 11, 10, 5))], "who string, a timestamp, b timestamp")
    assert person.business_time(times, "a", "b", "who").collect()[0][3:] == business_time(times, "a", "b", calendar).collect()[0][3:]


@pytest.mark.parametrize("row, message", [(("bruno", DAY(2025, 3, 1), None, "late"), "two calendar classes"),
                                          (("fabio", None, None, "nights"), "unknown calendar class")])
def test_contradictions_stop_the_job(spark, calendar, row, message):
    person = PersonCalendar(calendar, spark.createDataFrame([*ROWS, row], ASSIGNED), CLASS_DAYS)
    with pytest.raises(Exception, match=message):
        person.pieces.collect()


def test_an_empty_table(spark, calendar):
    person = PersonCalendar(calendar, spark.createDataFrame([], ASSIGNED))
    none = spark.createDataFrame([], "_aprovador string, data_aprovacao date")
    assert person.worked_weeks(none).count() == 0
