"""Catalog readers (S1) round-trip, and report options not covered by the driver queries."""

import tempfile

from pyspark.sql import functions as F

from ratify.operators import reports
from ratify.plans.fact import FactOptions, RuleTables, approval_fact, fact_rows
from ratify.sources.catalog import read_sources
from ratify.sources.schemas import SOURCE_SCHEMAS

from tests import fixtures as FX


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_read_sources_round_trip(spark):
    t = FX.tables(spark)
    root = tempfile.mkdtemp(prefix="ratify-src-")
    locations = {}
    for name in SOURCE_SCHEMAS:
        df = getattr(t, name)
        # upstream files may carry extra columns and other physical types
        df = df.withColumn("extra_col", F.lit("x"))
        if name == "services":
            df = df.withColumn("OrderServiceCode", F.col("OrderServiceCode").cast("int"))
        df.write.parquet(f"{root}/{name}")
        locations[name] = f"{root}/{name}"
    back = read_sources(spark, locations)
    assert "extra_col" not in back.services.columns
    assert dict(back.services.dtypes)["OrderServiceCode"] == "bigint"
    back.roster, back.customer_rules = t.roster, t.customer_rules
    rules = RuleTables.default(spark, 1, t.customer_rules)
    assert _rows(approval_fact(back, rules, FactOptions())) == _rows(approval_fact(t, rules, FactOptions()))


def test_row_security_admin_and_consultant(spark):
    t = FX.tables(spark)
    rows = fact_rows(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions())
    hier = spark.createDataFrame(
        [("ana@x", "ana", "sup@x", "sup", "P1"), ("bruno@x", "bruno", "sup@x", "sup", "P1"),
         ("fabio@x", "fabio", "other@x", "other", "P2")],
        "consultant_email string, consultant_name string, supervisor_email string, "
        "supervisor_name string, portfolio string")
    assert reports.visible_rows(rows, hier, "boss@x", admins=("boss@x",)).count() == rows.count()
    sup = {r._aprovador for r in reports.visible_rows(rows, hier, "sup@x").collect()}
    assert sup == {"ana", "bruno"}
    own = {r._aprovador for r in reports.visible_rows(rows, hier, "fabio@x").collect()}
    assert own == {"fabio"}
    sl = reports.period_slice(rows, hier, start="2025-03-04", supervisor="sup")
    assert {(r.OrderServiceCode) for r in sl.collect()} == {108}


def test_approver_summary_week_grain_rollup(spark):
    t = FX.tables(spark)
    rows = fact_rows(t, RuleTables.default(spark, 1, t.customer_rules), FactOptions())
    hier = spark.createDataFrame([("ana@x", "ana", "sup@x", "sup", "P1")],
                                 "consultant_email string, consultant_name string, "
                                 "supervisor_email string, supervisor_name string, portfolio string")
    out = reports.approver_summary(rows, hier, grain="week").collect()
    total = [r for r in out if r.period is None]
    assert len(total) == 1 and total[0].orders == 6
    ana = [r for r in out if r._aprovador == "ana" and r.level == 0]
    assert ana[0].supervisor_name == "sup" and ana[0].period == 202510 and ana[0].orders == 1
