"""Replace and refresh as one commit (S3, S6): readers see all of a write or nothing of it."""

import dataclasses
import datetime as dt
import os
import signal
import tempfile

import pytest

from ratify.plans.fact import FactOptions
from ratify.sources import schemas as S
from ratify.sources import versions as V
from ratify.sources.sinks import MONTH_COL, refresh_fact, replace_table
from ratify.sources.versions import CommitConflict, VersionedTable
from ratify.streaming.refresh import run_changes

from tests import fixtures as FX
from tests.test_sinks import _orders, _rows

SCHEMA = "k int, approval_month int"


@pytest.fixture
def table(spark):
    return VersionedTable(spark, f"{tempfile.mkdtemp(prefix='ratify-versions-')}/fact")


def _keys(df):
    return sorted((r.k, r.approval_month) for r in df.collect())


def _files(table):
    return {f"{d}/{f}" for d, _, names in os.walk(table.path) for f in names if f.endswith(".parquet")}


def _killed(batches):
    """The worker of the partition that holds k = 9 dies after rows of others were written."""
    for batch in batches:
        if (batch["k"] == 9).any():
            os.kill(os.getpid(), signal.SIGKILL)
        yield batch


def test_replace_rewrite_and_emptied_months(spark, table):
    with pytest.raises(ValueError):
        table.read()
    assert table.replace(spark.createDataFrame([(1, 202501), (2, 202502), (3, 202503)], SCHEMA)) == [202501, 202502, 202503]
    before = _files(table)
    old = table.read()
    # month 2 rewritten, month 3 emptied, month 1 as it was, in one commit
    assert table.rewrite(spark.createDataFrame([(5, 202502)], SCHEMA), {202502, 202503}.__contains__) == [202502]
    assert table.months() == [202501, 202502] and _keys(table.read()) == [(1, 202501), (5, 202502)]
    assert before <= _files(table)
    assert _keys(old) == _keys(table.read(1)) == [(1, 202501), (2, 202502), (3, 202503)]
    plan = table.read().where("approval_month = 202501")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and _keys(table.read().where("approval_month = 202501")) == [(1, 202501)]
    # other columns only if all months are replaced
    with pytest.raises(ValueError):
        table.rewrite(spark.createDataFrame([("x", 202502)], "name string, approval_month int"), {202502}.__contains__)
    assert table.replace(spark.createDataFrame([], SCHEMA)) == [] and _keys(table.read()) == []
    assert table.read().columns == ["k", "approval_month"]


def test_a_killed_task_leaves_readers_on_the_old_commit(spark, table):
    table.replace(spark.createDataFrame([(1, 202501), (2, 202502)], SCHEMA))
    rows = spark.createDataFrame([(i, 202501 + i % 3) for i in range(10)], SCHEMA).repartitionByRange(4, "k")
    with pytest.raises(Exception):
        table.replace(rows.mapInPandas(_killed, SCHEMA))
    assert _keys(table.read()) == [(1, 202501), (2, 202502)] and table.months() == [202501, 202502]
    assert table.replace(rows) == [202501, 202502, 202503] and table.read().count() == 10


def test_a_writer_that_dies_before_its_commit(spark, table, monkeypatch):
    table.replace(spark.createDataFrame([(1, 202501)], SCHEMA))
    monkeypatch.setattr(V, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        table.replace(spark.createDataFrame([(7, 202507)], SCHEMA))
    monkeypatch.undo()
    assert _keys(table.read()) == [(1, 202501)]
    assert len(table.clean_up()) == 1 and _keys(table.read()) == [(1, 202501)]


def test_the_second_of_two_writers_is_refused(spark, table, monkeypatch):
    table.replace(spark.createDataFrame([(1, 202501)], SCHEMA))
    seen = V.newest(spark, table.path)
    table.rewrite(spark.createDataFrame([(2, 202502)], SCHEMA), {202502}.__contains__)
    monkeypatch.setattr(V, "newest", lambda *a: seen)
    with pytest.raises(CommitConflict):
        table.rewrite(spark.createDataFrame([(3, 202503)], SCHEMA), {202503}.__contains__)
    monkeypatch.undo()
    assert _keys(table.read()) == [(1, 202501), (2, 202502)]


def test_clean_up_keeps_what_the_last_commits_name(spark, table):
    for k in range(4):
        table.rewrite(spark.createDataFrame([(k, 202501 + k % 2)], SCHEMA), lambda month, k=k: month == 202501 + k % 2)
    with pytest.raises(ValueError):
        table.clean_up(0)
    assert len(table.clean_up(1)) == 2 and _keys(table.read()) == [(2, 202501), (3, 202502)]
    assert sorted(V.commits(spark, table.path)) == [4] and table.clean_up(1) == []
    table.replace(spark.createDataFrame([(9, 202501)], SCHEMA))
    assert _keys(table.read(4)) == [(2, 202501), (3, 202502)]


def test_rows_without_a_month_are_refused(spark, table):
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([(1, None)], SCHEMA))
    assert table.months() == []


def test_replace_table_sorts_within_files(spark, table):
    rows = spark.createDataFrame([(i * 7 % 50, dt.date(2025, 1 + i % 2, 3)) for i in range(50)], "k int, data_aprovacao date")
    replace_table(rows, path=table, sort_within=["k"])
    assert table.months() == [202501, 202502] and table.read().count() == 50
    for file in _files(table):
        keys = [r.k for r in spark.read.parquet(file).coalesce(1).collect()]
        assert keys == sorted(keys)
    with pytest.raises(ValueError):
        replace_table(rows, name="somewhere", path=table)


def test_refresh_of_a_versioned_fact_equals_a_full_rebuild(spark):
    t = FX.tables(spark)
    root = tempfile.mkdtemp(prefix="ratify-versioned-")
    fact, full = VersionedTable(spark, f"{root}/fact"), VersionedTable(spark, f"{root}/full")
    refresh_fact(spark, t, fact, FactOptions())
    codes = sorted(r[0] for r in fact.read().select("OrderServiceCode").distinct().collect())
    before = _orders(t, {codes[0]: "2025-02-28", codes[1]: "2025-03-31", codes[2]: "2025-02-13"})
    after = _orders(t, {codes[0]: "2025-02-28", codes[1]: "2025-04-02", codes[2]: "2025-02-27"})
    refresh_fact(spark, before, fact, FactOptions())
    refresh_fact(spark, after, fact, FactOptions(), since=dt.date(2025, 2, 13))
    refresh_fact(spark, after, full, FactOptions())
    assert _rows(fact.read()) == _rows(full.read()) and fact.months() == full.months()


def test_changes_of_sources_arrive_as_one_commit(spark):
    t = FX.tables(spark)
    root = tempfile.mkdtemp(prefix="ratify-versioned-changes-")
    fact, full = VersionedTable(spark, f"{root}/fact"), VersionedTable(spark, f"{root}/full")
    t.items.write.parquet(f"{root}/items/first")
    load = lambda: dataclasses.replace(t, items=spark.read.schema(S.ITEMS).parquet(f"{root}/items/*"))
    run = lambda: run_changes(spark, {"items": f"{root}/items/*"}, load, fact, FactOptions())
    made = run()
    assert made and run() == []
    order = fact.read().first()["OrderServiceCode"]
    late = t.items.limit(1).selectExpr(*[f"{order} AS MaintenanceId" if c == "MaintenanceId" else c for c in t.items.columns])
    late.write.parquet(f"{root}/items/late")
    assert run() and len(V.commits(spark, fact.path)) == 2
    refresh_fact(spark, load(), full, FactOptions())
    assert _rows(fact.read()) == _rows(full.read())
    assert MONTH_COL in fact.read().columns
