"""Refresh from every source: equal to a full rebuild, other months' files untouched."""

import dataclasses
import datetime as dt
import os
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ratify.operators import changes as C
from ratify.plans.fact import FactOptions
from ratify.sources import schemas as S
from ratify.sources.catalog import Tables
from ratify.sources.sinks import refresh_fact
from ratify.streaming.refresh import run_changes

from tests import fixtures as FX
from tests.test_sinks import _rows

SOURCES = ["services", "items", "history", "protocols", "attendances", "param_log", "users"]


@pytest.fixture(scope="module")
def t(spark):
    """Order 113 in February, 100 in April, the others in March; the calendar reaches over all."""
    base = FX.tables(spark)
    services = base.services
    for code, day in ((113, dt.datetime(2025, 2, 13, 10)), (100, dt.datetime(2025, 4, 10, 10))):
        services = services.withColumn("FirstApprovalTimestamp", F.when(
            F.col("OrderServiceCode") == code, F.lit(day)).otherwise(F.col("FirstApprovalTimestamp")).cast(
            base.services.schema["FirstApprovalTimestamp"].dataType))
    hol = spark.createDataFrame([(dt.date(2025, 3, 5), "Holiday")], "holiday_date date, label string")
    from ratify.operators.calendar import build_calendar
    return dataclasses.replace(base, services=services, dates=build_calendar(spark, dt.date(2025, 1, 1), dt.date(2025, 5, 31), hol))


def _codes(df):
    return {r[0] for r in df.collect()}


def test_each_source_reaches_its_orders(spark, t):
    row = lambda source, *values: {source: spark.createDataFrame(
        [values], S._schema(*[(f.name, f.dataType) for f in S.SOURCE_SCHEMAS[source].fields if f.name in C.CHANGE_KEYS[source]]))}
    got = lambda change: _codes(C.touched_orders(change, t))
    assert got(row("items", 101)) == {101} and got(row("history", 102)) == {102} and got(row("protocols", 113)) == {113}
    assert got(row("attendances", 1)) == {101} and got(row("vehicles", 4)) == {111, 112}
    assert got(row("merchants", 3)) == {111, 112} and got(row("types", 3)) == {111, 112}
    assert got(row("statuses", 2)) == {102, 103}
    assert got(row("labors", 2)) == {113}
    assert got(row("param_log", 901, 586)) == {101} and got(row("param_log", 901, 587)) == set()
    # user 2 holds a role of some orders and, by code 20, was a member of client 901
    roles = _codes(t.services.where("2 in (Sk_FirstApprover, Sk_SecondApprover, Sk_ThirdApprover, Sk_ServiceOrderApprover)")
                   .select("OrderServiceCode"))
    assert got(row("users", 2, "20")) == roles | {101}
    assert got({"dates": spark.createDataFrame([(dt.date(2025, 4, 9),), (dt.date(2025, 4, 10),)], "ReferenceDate date")}) == {100}
    assert got({"customer_rules": spark.createDataFrame([(902, "x")], "customer_id long, class string")}) == _codes(
        t.services.where("Sk_MaintenanceVehicle = 3").select("OrderServiceCode"))
    assert got({"roster": spark.createDataFrame([("carla",)], S.ROSTER)}) == _codes(t.services.where(
        "3 in (Sk_FirstApprover, Sk_SecondApprover, Sk_ThirdApprover, Sk_ServiceOrderApprover)").select("OrderServiceCode"))
    assert got({}) == set()
    with pytest.raises(ValueError):
        C.touched_orders({"weather": t.users}, t)


def test_weeks_and_months():
    assert C.week_months(dt.date(2025, 4, 1)) == {202503, 202504} and C.week_months(dt.date(2025, 3, 12)) == {202503}
    assert C.month_range(202503) == (dt.date(2025, 2, 24), dt.date(2025, 4, 6))
    assert C.month_range(202412)[1] == dt.date(2025, 1, 5)
    assert C.month_ranges({202502, 202503, 202507}) == (
        (dt.date(2025, 1, 27), dt.date(2025, 4, 6)), (dt.date(2025, 6, 30), dt.date(2025, 8, 3)))


def test_late_rows_of_each_source_equal_a_full_rebuild(spark, t):
    root = tempfile.mkdtemp(prefix="ratify-changes-")
    landing = {s: f"{root}/landing/{s}" for s in SOURCES}
    for s in SOURCES:
        getattr(t, s).write.parquet(f"{landing[s]}/first")

    def load() -> Tables:
        return dataclasses.replace(t, **{s: spark.read.schema(S.SOURCE_SCHEMAS[s]).parquet(f"{landing[s]}/*") for s in SOURCES})

    def run():
        return run_changes(spark, {s: f"{p}/*" for s, p in landing.items()}, load, f"{root}/fact", FactOptions())

    def files():
        return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(f"{root}/fact") for f in names
                if "approval_month" in d}

    def land(source, name, *rows):
        spark.createDataFrame(rows, S.SOURCE_SCHEMAS[source]).coalesce(1).write.parquet(f"{landing[source]}/{name}")

    def check(months, name):
        before = files()
        assert run() == sorted(months)
        refresh_fact(spark, load(), f"{root}/full-{name}", FactOptions())
        assert _rows(spark.read.parquet(f"{root}/fact")) == _rows(spark.read.parquet(f"{root}/full-{name}"))
        after = files()
        kept = [f for f in before if int(f.split("approval_month=")[1][:6]) not in months]
        assert kept and all(after.get(f) == before[f] for f in kept)
        assert months == set() or before != after

    assert run() == [202502, 202503, 202504]
    check(set(), "none")
    land("items", "late", (900, 113, 1, D("70.00"), D("60.00"), D("12.00"), None, None, None, D("10.00"), D("9.00"), D("2"), None))
    check({202502}, "item")
    land("history", "late", (100, 14, dt.datetime(2025, 4, 1, 10, 0)))
    check({202504}, "history")
    land("param_log", "late", (904, 586, dt.datetime(2025, 2, 1, 8, 0), "", "70"))  # fabio, approver of 113
    check({202502}, "log")
    assert spark.read.parquet(f"{root}/fact").where("OrderServiceCode = 113").first()["preco_parceiro"]
    land("services", "late", (120, False, False, FX.ts(0), dt.datetime(2025, 4, 11, 9), None, None, None, "x", 1, 1, 1, 1, 4, 4, 4, 1))
    land("protocols", "late", (9, 113))
    check({202502, 202504}, "two")


def test_a_failed_run_is_made_good_by_the_next(spark, t):
    root = tempfile.mkdtemp(prefix="ratify-failed-")
    landing = {"items": f"{root}/items"}
    t.items.write.parquet(f"{landing['items']}/first")
    calls = []

    def load(fail=False):
        calls.append(fail)
        if fail:
            raise RuntimeError("no tables")
        return dataclasses.replace(t, items=spark.read.schema(S.ITEMS).parquet(f"{landing['items']}/*"))

    run = lambda fail=False: run_changes(spark, {"items": f"{landing['items']}/*"}, lambda: load(fail),
                                         f"{root}/fact", FactOptions())
    run()
    spark.createDataFrame([(901, 113, 1, D("5.00"), D("5.00"), None, None, None, None, D("1.00"), D("1.00"), D("1"), None)],
                          S.ITEMS).write.parquet(f"{landing['items']}/late")
    with pytest.raises(RuntimeError):
        run(True)
    assert run() == [202502] and run() == []
    refresh_fact(spark, load(), f"{root}/full", FactOptions())
    assert _rows(spark.read.parquet(f"{root}/fact")) == _rows(spark.read.parquet(f"{root}/full"))
