"""The fact at the grain of the order: the same measures as from its rows, without what they do not need."""

import dataclasses
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ratify.operators import reports
from ratify.operators.calendar import build_calendar, worked_days
from ratify.operators.weekly import weekly_days, weekly_summary, weekly_totals
from ratify.plans.driver import q_sla_attainment, q_weekly_distinct_days, q_worked_days
from ratify.plans.fact import FactOptions, RuleTables, attributed_orders, fact_rows, order_rows
from ratify.sources import schemas as S

from tests import fixtures as FX


@pytest.fixture(scope="module")
def t(spark):
    """Order 101's interval ends and begins on its day, so the fact has it twice."""
    return FX.tables(spark)


@pytest.fixture(scope="module")
def grains(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    return order_rows(t, rules, FactOptions()), fact_rows(t, rules, FactOptions())


def _rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_repeats_are_a_column(grains):
    orders, rows = grains
    counts = {r[0]: r[1] for r in rows.groupBy("OrderServiceCode").count().collect()}
    assert {r.OrderServiceCode: r._n_rows for r in orders.collect()} == counts and max(counts.values()) > 1
    assert _rows(orders.drop("_n_rows").dropDuplicates()) == _rows(rows.dropDuplicates())


def test_reports_are_the_same_from_both_grains(spark, t, grains):
    orders, rows = grains
    hierarchy = spark.createDataFrame([("a@x", "ana", "s@x", "sara", "p"), ("b@x", "bruno", "s@x", "sara", "q")], S.HIERARCHY)
    targets = spark.createDataFrame([(900, Decimal(1)), (901, Decimal(100))], "customer_id long, target_hours decimal(9,2)")
    audit = spark.createDataFrame([(101, Decimal(5)), (101, Decimal(6))], "OrderServiceCode long, disallowed_amount decimal(18,2)")
    plain = order_rows(t, None, FactOptions(), priced=False)
    for grain in ("week", "month"):
        assert _rows(reports.approver_summary(orders, hierarchy, grain)) == _rows(reports.approver_summary(rows, hierarchy, grain))
    assert _rows(weekly_summary(orders)) == _rows(weekly_summary(rows))
    assert _rows(reports.adherence_matrix(orders)) == _rows(reports.adherence_matrix(rows))
    for make in (lambda f: reports.sla_attainment(f, targets), reports.average_ticket, lambda f: reports.audit_cross(f, audit),
                 lambda f: worked_days(f, t.dates, t.roster)):
        assert _rows(make(plain)) == _rows(make(rows)) == _rows(make(orders))
    days = weekly_days(attributed_orders(t, FactOptions()))
    assert _rows(days) == _rows(weekly_totals(rows).select("YearWeek", "_aprovador", "total_dias_uteis_semana"))


def test_names_and_days_reach_the_attribution(spark, t, grains):
    _, rows = grains
    hierarchy = spark.createDataFrame([("a@x", "ana", "s@x", "sara", "p"), ("b@x", "bruno", "s@x", "sara", "q"),
                                       ("n@x", None, "s@x", "sara", "q")], S.HIERARCHY)
    mine = fact_rows(t, None, FactOptions(approvers=reports.visible_names(hierarchy, "s@x")))
    assert _rows(mine) == _rows(reports.visible_rows(rows, hierarchy, "s@x")) and mine.count()
    year = ((dt.date(2025, 3, 3), dt.date(2025, 3, 4)),)
    part = fact_rows(t, None, FactOptions(days=year, approvers=reports.sliced_names(hierarchy, portfolio="q")))
    assert _rows(part) == _rows(reports.period_slice(rows, hierarchy, "2025-03-03", "2025-03-04", portfolio="q")) and part.count()


def test_a_bridge_gives_way_to_a_holiday(spark):
    both = spark.createDataFrame([(dt.date(2025, 1, 1), "Holiday"), (dt.date(2025, 1, 1), "Bridge"),
                                  (dt.date(2025, 1, 2), "Bridge")], S.HOLIDAYS)
    days = build_calendar(spark, dt.date(2025, 1, 1), dt.date(2025, 1, 3), both)
    assert [r.HolidayOrBridge for r in days.orderBy("ReferenceDate").collect()] == ["Holiday", "Bridge", None]


@pytest.mark.parametrize("query, scans", [
    (q_worked_days, {"orders": 1, "lineitem": 0}), (q_weekly_distinct_days, {"orders": 1, "lineitem": 0}),
    (q_sla_attainment, {"orders": 2, "lineitem": 2})])
def test_plans_read_what_they_need(spark, query, scans):
    """sla_attainment: orders for rows and protocols, line items for items and attendances; no change log, no repeat."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for table, most in scans.items():
        assert sum("FileScan" in line and f"/{table}.parquet" in line for line in plan.splitlines()) <= most
    assert "explode(sequence" not in plan and F is not None and dataclasses is not None
