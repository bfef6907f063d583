"""Properties of SURVEY §5 on the driver tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from ratify.operators.changelog import membership_intervals
from ratify.plans.driver import _tables_rules
from ratify.plans.fact import approval_fact

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="no driver tables")


@pytest.fixture(scope="module")
def env(spark):
    return _tables_rules(spark, SF)


def test_adherent_never_exceeds_total(spark, env):
    t, rules, opts = env
    f = approval_fact(t, rules, opts)
    bad = f.filter(F.col("total_aprovado_aderente") > F.col("total_aprovado_referencial")).count()
    assert bad == 0


def test_interval_start_not_after_end(spark, env):
    t, _, _ = env
    iv = membership_intervals(t.param_log, t.users)
    assert iv.filter(F.col("DataInicioDate") > F.col("DataFimDate")).count() == 0
    assert iv.filter(F.col("DataFim").isNotNull() & (F.col("DataInicio") > F.col("DataFim"))).count() == 0


def test_weekly_sum_equals_sum_of_row_weights(spark, env):
    t, rules, opts = env
    f = approval_fact(t, rules, opts)
    per_week = f.groupBy("YearWeek", "_aprovador").agg(
        F.sum("peso_os").alias("s"), F.count(F.lit(1)).alias("n"),
        F.max("soma_peso_os_semana_aprovador").alias("w"),
        F.max("total_os_semana_aprovador").alias("wn"))
    assert per_week.filter((F.col("s") != F.col("w")) | (F.col("n") != F.col("wn"))).count() == 0


def test_exists_mode_one_row_per_order(spark, env):
    t, rules, opts = env
    faithful = approval_fact(t, rules, opts)
    exists = approval_fact(t, rules, opts.__class__(**{**opts.__dict__, "price_match": "exists"}))
    assert exists.count() == faithful.select("OrderServiceCode").distinct().count()
    assert exists.count() == exists.select("OrderServiceCode").distinct().count()


def test_dedup_fanout_never_raises_item_counts(spark, env):
    t, rules, opts = env
    faithful = approval_fact(t, rules, opts).select("OrderServiceCode", "valor_orcado").distinct()
    dedup = approval_fact(t, rules, opts.__class__(**{**opts.__dict__, "item_fanout": "dedup"})) \
        .select("OrderServiceCode", F.col("valor_orcado").alias("v2")).distinct()
    j = faithful.join(dedup, "OrderServiceCode")
    assert j.filter(F.col("v2") > F.col("valor_orcado")).count() == 0
    assert j.filter(F.col("v2") < F.col("valor_orcado")).count() > 0   # fan-out orders exist
