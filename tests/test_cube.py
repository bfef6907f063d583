"""The day cube (C22, C28): reports from it equal those from the fact; a refreshed month rewrites one part."""

import os

import pytest

from ratify.operators import reports
from ratify.operators.cube import day_cube, refresh_cube, slice_totals, summary_from_cube
from ratify.plans.fact import FactOptions, RuleTables, fact_rows, order_rows
from ratify.sources import schemas as S
from ratify.sources.versions import MONTH_COL, VersionedTable

from tests import fixtures as FX
from tests.test_sinks import _orders


def _rows(df):
    return sorted(str(tuple(r)) for r in df.selectExpr(*[
        f"CAST({c} AS DOUBLE) AS {c}" if c == "soma_peso_os" else c for c in sorted(df.columns)]).collect())


@pytest.fixture(scope="module")
def spread(spark):
    """The fixture's orders over several months; one order is in the fact twice."""
    t = FX.tables(spark)
    t = _orders(t, {102: "2025-02-28", 103: "2025-04-02", 113: "2025-02-13"})
    rules = RuleTables.default(spark, 1, t.customer_rules)
    return order_rows(t, rules, FactOptions()).cache(), fact_rows(t, rules, FactOptions()).cache()


@pytest.fixture(scope="module")
def hierarchy(spark):
    return spark.createDataFrame([("a@x", "ana", "s@x", "sara", "p"), ("b@x", "bruno", "s@x", "sara", "q"),
                                  ("a2@x", "ana", "t@x", "tom", "p"), ("n@x", None, "t@x", "tom", "p")], S.HIERARCHY)


def test_reports_from_the_cube_equal_those_from_the_fact(spread, hierarchy):
    orders, rows = spread
    cube = day_cube(orders)
    assert cube.columns == day_cube(rows).columns
    assert _rows(cube) == _rows(day_cube(rows)) and cube.where("fact_rows > orders").count()
    for grain in ("week", "month"):
        assert _rows(summary_from_cube(cube, hierarchy, grain)) == _rows(reports.approver_summary(rows, hierarchy, grain))
    with pytest.raises(ValueError):
        summary_from_cube(cube, hierarchy, "decade")
    for args in ({}, {"start": "2025-02-14"}, {"end": "2025-03-05"}, {"start": "2025-03-03", "end": "2025-03-05", "portfolio": "p"},
                 {"supervisor": "sara"}, {"start": "2030-01-01"}):
        part = reports.period_slice(rows, hierarchy, **args)
        want = part.groupBy("_aprovador").agg({"*": "count"}).collect()
        assert {(r[0], r[1]) for r in want} == {(r._aprovador, r.fact_rows) for r in slice_totals(cube, hierarchy, **args).collect()}
        assert _rows(slice_totals(cube, hierarchy, **args)) == _rows(slice_totals(day_cube(part), hierarchy))


def test_one_month_rewrites_one_part(spark, spread, hierarchy, tmp_path):
    orders, rows = spread
    table = VersionedTable(spark, f"{tmp_path}/cube")
    months = refresh_cube(table, orders)
    assert len(months) > 1 and 202503 in months and _rows(table.read()) == _rows(day_cube(orders))
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")}
    before = files()
    march = orders.where("data_aprovacao BETWEEN '2025-03-01' AND '2025-03-31'").agg({"OrderServiceCode": "min"}).first()[0]
    fewer = orders.where(f"OrderServiceCode <> {march}")
    assert refresh_cube(table, fewer, {202503}) == [202503]
    made = files() - before
    assert before <= files() and made and all(f"{MONTH_COL}=202503" in f for f in made)
    assert _rows(table.read()) == _rows(day_cube(fewer))
    plan = slice_totals(table.read(), hierarchy, "2025-03-01", "2025-03-31")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(approval_month" in plan


def test_empty_fact(spark, spread, hierarchy, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/cube")
    assert refresh_cube(table, spread[0].limit(0)) == []
    assert slice_totals(table.read(), hierarchy).count() == 0
    assert day_cube(spread[1].limit(0)).count() == 0
