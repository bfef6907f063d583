"""Sinks (S2-S4, S6), governed parameter tables (S5) and the streaming refresh."""

import dataclasses
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ratify.plans.fact import FactOptions, RuleTables, approval_fact
from ratify.sources import schemas as S
from ratify.sources.catalog import read_parameter_table
from ratify.sources.sinks import (
    MONTH_COL, create_or_replace_view, refresh_fact, register_temp_view, replace_table,
)
from ratify.streaming.refresh import run_refresh

from tests import fixtures as FX


@pytest.fixture(scope="module")
def t(spark):
    return FX.tables(spark)


def _rows(df):
    cols = sorted(c for c in df.columns if c != MONTH_COL)
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def test_views(spark, t):
    fact = approval_fact(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions())
    register_temp_view(fact, "fact_v")
    assert spark.sql("SELECT count(*) FROM fact_v").first()[0] == fact.count()
    name = create_or_replace_view(fact, "fact_g", global_view=True)
    assert spark.table(name).count() == fact.count()


def test_replace_table_partitions_by_month(spark, t):
    out = tempfile.mkdtemp(prefix="ratify-sink-")
    fact = approval_fact(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions())
    replace_table(fact, path=f"{out}/fact", sort_within=["_aprovador", "data_aprovacao"])
    back = spark.read.parquet(f"{out}/fact")
    assert {r[0] for r in back.select(MONTH_COL).distinct().collect()} == {202503}
    assert _rows(back) == _rows(fact)


def test_refresh_is_idempotent(spark, t):
    out = f"{tempfile.mkdtemp(prefix='ratify-refresh-')}/fact"
    opts = FactOptions()
    assert refresh_fact(spark, t, out, opts) == [202503]
    first = _rows(spark.read.parquet(out))
    assert refresh_fact(spark, t, out, opts, since=dt.date(2025, 3, 4)) == [202503]
    assert _rows(spark.read.parquet(out)) == first


def test_parameter_table_checks(spark):
    d = tempfile.mkdtemp(prefix="ratify-param-")
    good, bad = f"{d}/good.csv", f"{d}/bad.csv"
    with open(good, "w") as f:
        f.write("web_user_name\nbruno\nana\n")
    with open(bad, "w") as f:
        f.write("web_user_name\nbruno\nbruno\n")
    assert read_parameter_table(spark, "roster", good, fmt="csv").count() == 2
    with pytest.raises(ValueError):
        read_parameter_table(spark, "roster", bad, fmt="csv")


def test_streaming_refresh_processes_new_files_once(spark, t):
    root = tempfile.mkdtemp(prefix="ratify-stream-")
    landing, out, ckpt = f"{root}/landing", f"{root}/fact", f"{root}/ckpt"
    os.makedirs(landing)
    t.services.write.mode("overwrite").parquet(f"{landing}/batch1")

    def load():
        return dataclasses.replace(t, services=spark.read.schema(S.SERVICES).parquet(f"{landing}/*"))

    src = f"{landing}/*"
    first = run_refresh(spark, src, S.SERVICES, load, out, FactOptions(), checkpoint=ckpt)
    assert first == [[202503]]
    assert spark.read.parquet(out).select("OrderServiceCode").distinct().count() == 6
    again = run_refresh(spark, src, S.SERVICES, load, out, FactOptions(), checkpoint=ckpt)
    assert again == []                     # nothing new landed
    assert F is not None


def _orders(t, days):
    """The fixture's services with approval stages moved to given days, by order code."""
    moved = t.services
    for code, day in days.items():
        for c in ("FirstApprovalTimestamp", "SecondApprovalTimestamp", "ThirdApprovalTimestamp", "DisapprovalTimestamp"):
            hit = (F.col("OrderServiceCode") == code) & F.col(c).isNotNull()
            moved = moved.withColumn(c, F.when(hit, F.lit(f"{day} 10:00:00").cast(t.services.schema[c].dataType)).otherwise(F.col(c)))
    return dataclasses.replace(t, services=moved)


def test_replace_drops_old_months(spark, t):
    out = f"{tempfile.mkdtemp(prefix='ratify-replace-')}/fact"
    rows = spark.createDataFrame([(1, dt.date(2025, 2, 3)), (2, dt.date(2025, 3, 3))], "k int, data_aprovacao date")
    replace_table(rows, path=out)
    replace_table(rows.where("k = 2"), path=out)
    assert [r.k for r in spark.read.parquet(out).collect()] == [2]


def test_refresh_equals_full_rebuild(spark, t):
    """A week over two months, a moved order and a month that empties."""
    codes = sorted(r[0] for r in approval_fact(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions())
                   .select("OrderServiceCode").distinct().collect())
    root = tempfile.mkdtemp(prefix="ratify-weeks-")
    before = _orders(t, {codes[0]: "2025-02-28", codes[1]: "2025-03-31", codes[2]: "2025-02-13"})
    after = _orders(t, {codes[0]: "2025-02-28", codes[1]: "2025-04-02", codes[2]: "2025-02-27"})
    refresh_fact(spark, before, f"{root}/fact", FactOptions())
    refresh_fact(spark, after, f"{root}/fact", FactOptions(), since=dt.date(2025, 2, 13))
    refresh_fact(spark, after, f"{root}/full", FactOptions())
    assert _rows(spark.read.parquet(f"{root}/fact")) == _rows(spark.read.parquet(f"{root}/full"))
    late = _orders(t, {codes[0]: "2025-02-28", codes[1]: "2025-02-28", codes[2]: "2025-02-27"})
    refresh_fact(spark, late, f"{root}/fact", FactOptions(), since=dt.date(2025, 2, 28))
    refresh_fact(spark, late, f"{root}/again", FactOptions())
    got, full = spark.read.parquet(f"{root}/fact"), spark.read.parquet(f"{root}/again")
    assert _rows(got) == _rows(full)
    assert 202504 not in {r[0] for r in got.select(MONTH_COL).distinct().collect()}


def test_refresh_computes_the_rows_once_and_leaves_nothing_staged(spark, t):
    """Items and change log are read once, for rows and weekly totals and for both uses of the log's events."""
    from ratify.session import ensure_checkpoint_dir

    staged = lambda: {f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if f.startswith("fact-")}
    before = staged()
    items, seen_items = FX.counted(t.items, "QuotedPrice")
    log, seen_log = FX.counted(t.param_log, "NewValueDescription")
    root = tempfile.mkdtemp(prefix="ratify-once-")
    assert refresh_fact(spark, dataclasses.replace(t, items=items, param_log=log), f"{root}/fact", FactOptions()) == [202503]
    assert (seen_items.value, seen_log.value) == (t.items.count(), t.param_log.count())
    assert _rows(spark.read.parquet(f"{root}/fact")) == _rows(
        approval_fact(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions()))
    assert staged() == before


def test_refresh_without_rows_empties_its_months(spark, t):
    out = f"{tempfile.mkdtemp(prefix='ratify-empty-')}/fact"
    refresh_fact(spark, t, out, FactOptions())
    assert refresh_fact(spark, dataclasses.replace(t, services=t.services.limit(0)), out, FactOptions()) == []
    assert not [d for d in os.listdir(out) if "approval_month" in d]
