"""Order-clustered storage: same fact, no exchange over items or history, early periods not read."""

import dataclasses
import re
import tempfile
import uuid

import pytest

from ratify.plans.driver import _tables_rules
from ratify.plans.fact import FactOptions, RuleTables, approval_fact, order_base
from ratify.sources.colocated import ORDER_KEYS, PERIOD, in_period, order_periods, read_by_order, register_by_order, write_by_order

from tests import fixtures as FX

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def _plan(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    t, rules, opts = _tables_rules(spark, SF)
    name, path = f"t_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="ratify-buckets-")
    write_by_order(t, name, path, 16)
    return t, rules, opts, name, path


def test_every_row_is_stored_once(spark, stored):
    t, _, _, name, _ = stored
    back = read_by_order(spark, name, t)
    for source in ORDER_KEYS:
        assert _rows(getattr(back, source).drop(PERIOD)) == _rows(getattr(t, source))


def test_plans_run_bucket_by_bucket(spark, stored):
    t, rules, opts, name, _ = stored
    back = read_by_order(spark, name, t)
    conf = {"spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        late = dataclasses.replace(opts, start_date="1999-01-01")
        plan, plain = (_plan(spark, order_base(x, rules, late).select(
            "OrderServiceCode", "_valor_os", "n_items", "total_int_rev")) for x in (back, t))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    dealt = lambda text: re.findall(r"Exchange hashpartitioning\((MaintenanceId|_it_order|order_code|cd_manutencao)", text)
    assert dealt(plain) and not dealt(plan)
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"/{name}" not in line and "order_period" in line]
    assert len(scans) >= 3 and all("order_period" in s and "199901" in s for s in scans)
    assert "Bucketed: true" in plan


def test_fact_from_buckets_equals_the_plain_one(spark, stored):
    t, rules, opts, name, path = stored
    for start in (opts.start_date, "1999-06-15"):
        own = dataclasses.replace(opts, start_date=start)
        assert _rows(approval_fact(read_by_order(spark, name, t), rules, own)) == _rows(approval_fact(t, rules, own))
    again = f"t_{uuid.uuid4().hex}"
    register_by_order(spark, again, path, 16)  # as a session does whose catalog has not seen the write
    reopened = read_by_order(spark, again, t)
    assert _rows(in_period(reopened.items, own_first())) == _rows(in_period(read_by_order(spark, name, t).items, own_first()))
    assert reopened.items.count() == t.items.count()


def test_longer_periods_are_named_by_their_last_month(spark, stored):
    t = stored[0]
    month, quarter, year = ({r["_order"]: r[PERIOD] for r in order_periods(t.services, m).collect()} for m in (1, 3, 12))
    assert all(quarter[k] == p - p % 100 + (p % 100 + 2) // 3 * 3 and year[k] == p - p % 100 + 12 for k, p in month.items() if p)
    with pytest.raises(ValueError):
        order_periods(t.services, 5)


def own_first():
    import datetime as dt
    return dt.date(1998, 1, 1)


def test_orders_without_stages_and_items_without_orders(spark):
    t = FX.tables(spark)
    extra = t.items.limit(1).withColumn("MaintenanceId", t.items["MaintenanceId"] * 0 - 5)
    t = dataclasses.replace(t, items=t.items.unionByName(extra))
    name, path = f"t_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="ratify-buckets-")
    write_by_order(t, name, path, 4)
    back = read_by_order(spark, name, t)
    assert {r[0] for r in back.items.where("MaintenanceId = -5").select(PERIOD).collect()} == {0}
    rules = RuleTables.default(spark, 1, t.customer_rules)
    assert _rows(approval_fact(back, rules, FactOptions())) == _rows(approval_fact(t, rules, FactOptions()))


def test_sources_are_read_once_and_orders_without_a_code_have_no_period(spark):
    t = FX.tables(spark)
    nameless = t.services.limit(2).withColumn("OrderServiceCode", t.services["OrderServiceCode"] * None)
    services, seen = FX.counted(t.services.unionByName(nameless), "IsExternalApproval")
    stages, seen_stages = FX.counted(services, "FirstApprovalTimestamp")
    name, path = f"t_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="ratify-buckets-")
    write_by_order(dataclasses.replace(t, services=stages), name, path, 4)
    back = read_by_order(spark, name, t)
    n = t.services.count() + 2
    assert (seen.value, seen_stages.value) == (n, n)  # the periods of the other sources come from the stored table
    assert {r[0] for r in back.services.where("OrderServiceCode IS NULL").select(PERIOD).collect()} == {0}
    periods = {r["_order"]: r[PERIOD] for r in order_periods(t.services).collect()}
    for source, key in ORDER_KEYS.items():
        assert all(r[1] == periods.get(r[0], 0) for r in getattr(back, source).select(key, PERIOD).collect())
