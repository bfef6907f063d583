"""Contracts of sheets and dimensions: each rule with a row that breaks it, all kinds, one scan."""

import tempfile

import pytest
from pyspark.sql import functions as F

from ratify.plans.fact import FactOptions, RuleTables, approval_fact
from ratify.sources.governed import CONTRACTS, DIMENSIONS, SHEETS, govern, read_governed, with_faults

from tests import fixtures as FX


def _path(name="sheet"):
    return f"{tempfile.mkdtemp(prefix='ratify-sheets-')}/{name}"


@pytest.fixture(scope="module")
def t(spark):
    return FX.tables(spark)


@pytest.fixture(scope="module")
def tables(t):
    return {name: getattr(t, name) for name in ("users", "services", "vehicles", "labors")}


# kind -> rows as text, each with the faults it has
CASES = {
    "roster": [(("ana",), []), (("bruno",), ["key"]), (("bruno",), ["key"]), (("nobody",), ["refers:web_user_name"]),
               ((None,), ["missing:web_user_name"]), ((None,), ["missing:web_user_name"])],
    "hierarchy": [(("a@x", "ana", "s@x", None, None), []), (("b@x", "zoe", None, "s", "p"), ["missing:supervisor_email", "refers:consultant_name"])],
    "audit": [(("100", "5.00"), []), (("100", "5.00"), []), (("101", "-1"), ["range:disallowed_amount"]),
              (("9", " 1 "), ["refers:OrderServiceCode"]), (("x1", ""), ["missing:OrderServiceCode", "missing:disallowed_amount", "type:OrderServiceCode"])],
    "sla_target": [(("900", "24"), []), (("901", "0"), ["range:target_hours"]), (("1", "8"), ["refers:customer_id"])],
    "holidays": [(("2025-01-01", "Holiday"), []), (("2025-02-30", "Bridge"), ["missing:holiday_date", "type:holiday_date"]),
                 (("2025-01-02", "bridge"), ["domain:label"])],
    "customer_rules": [(("900", "public"), []), (("900", "special"), []), (("901", "gold"), ["domain:class"])],
    "thresholds": [(("Leve", "1", "2"), []), (("Moto", "3", "2"), ["order:lo<=hi"]), (("Suv", "-1", None), ["missing:hi", "range:lo"])],
    "factors": [(("alta_monta", "1.5"), []), (("media_monta", "0"), ["range:factor"]), (("alta", "1"), ["domain:severity"])],
    "minutes": [(("Corretiva", "01-03", "8"), []), (("Corretiva", "1-3", "8"), ["domain:band"]), (("Sinistro", "01-03", "8.5h"), ["missing:minutes", "type:minutes"]),
                (("Other", "01-03", "1441"), ["domain:kind", "range:minutes"])],
    "labor_whitelist": [(("SUBSTITUIR",), []), (("PINTAR",), ["refers:labor_name"])],
}


def _sheet(spark, kind):
    names = CONTRACTS[kind].schema.names
    return spark.createDataFrame([(i, *row) for i, (row, _) in enumerate(CASES[kind])],
                                 "n int, " + ", ".join(f"{c} string" for c in names))


def test_every_kind_is_there():
    assert set(CASES) == set(SHEETS) and len(SHEETS) == 10


@pytest.mark.parametrize("kind", sorted(CASES))
def test_each_rule(spark, tables, kind):
    got = govern(_sheet(spark, kind), kind, _path(), tables)
    want = [sorted(faults) for _, faults in CASES[kind]]
    refused = sorted(sorted(r._faults) for r in got.refused.collect())
    assert refused == sorted(f for f in want if f)
    assert (got.rows, got.n_refused) == (len(want), len(refused)) and got.accepted.count() == len(want) - len(refused)
    assert got.faults == {f: sum(f in fs for fs in want) for f in {f for fs in want for f in fs}}
    assert got.accepted.columns == CONTRACTS[kind].schema.names
    with pytest.raises(ValueError, match="refused"):
        got.require_clean()


def test_one_job_and_one_scan(spark, tables):
    path = _path()
    _sheet(spark, "sla_target").write.parquet(path)
    plan = with_faults(spark.read.parquet(path), SHEETS["sla_target"], tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_csv_with_one_bad_cell(spark, tables):
    path = _path("csv")
    _sheet(spark, "sla_target").drop("n").write.option("header", "true").csv(path)
    got = read_governed(spark, "sla_target", path, _path(), "csv", tables)
    assert [tuple(r) for r in got.accepted.collect()] == [(900, 24)] and got.n_refused == 2


def test_dimensions_and_lacking_columns(spark, t):
    for name in DIMENSIONS:
        table = getattr(t, name)
        assert govern(table, name, _path(), {"vehicles": t.vehicles}).require_clean().count() == table.count()
    twice = govern(t.users.unionAll(t.users.where("Sk_WebUser = 1")), "users", _path())
    assert twice.faults == {"key": 2} and twice.n_refused == 2
    with pytest.raises(ValueError, match="missing columns"):
        govern(t.users.drop("WebUserName"), "users", _path())
    empty = govern(t.users.limit(0), "users", _path())
    assert (empty.rows, empty.faults) == (0, {}) and empty.require_clean().count() == 0


def test_the_fact_takes_governed_rules(spark, t, tables):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    sheets = {name: govern(getattr(rules, name), name, _path(), {}).require_clean()
              for name in ("thresholds", "factors", "minutes", "customer_rules", "labor_whitelist")}
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert key(approval_fact(t, rules.with_sheets(sheets), FactOptions())) == key(approval_fact(t, rules, FactOptions()))
    double = sheets | {"minutes": sheets["minutes"].withColumn("minutes", F.col("minutes") * 2)}
    assert key(approval_fact(t, rules.with_sheets(double), FactOptions())) != key(approval_fact(t, rules, FactOptions()))
    with pytest.raises(ValueError, match="no rules"):
        rules.with_sheets({"bands": t.users})
