"""The stored view: read by a second session, equal to ``approval_fact`` in the variants of V3, V4, J14b and the fan-out."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from ratify.plans.driver import analog_options, analog_tables
from ratify.plans.fact import FactOptions, RuleTables, approval_fact
from ratify.plans.view_sql import fact_view_sql, store_fact_view
from ratify.sources.schemas import SOURCE_SCHEMAS

from tests import fixtures as FX

VARIANTS = [{}, {"weekday_policy": "none"}, {"sla_grain": "date", "price_match": "exists"},
            {"weekday_policy": "none", "sla_grain": "date", "strip_whitespace": False, "item_fanout": "dedup"}]


def _rows(df):
    return sorted(str(tuple(r)) for r in df.select(*[
        F.round(F.col(f.name).cast("double"), 9) if "decimal" in f.dataType.simpleString() or f.dataType.simpleString() == "double"
        else F.col(f.name).cast("string") for f in df.schema.fields]).collect())


def _stored(spark, t):
    tag = f"v{uuid.uuid4().hex[:8]}"
    names = {}
    for name in [*SOURCE_SCHEMAS, "roster", "customer_rules"]:
        names[name] = f"{tag}_{name}"
        getattr(t, name).write.option("path", f"{tempfile.mkdtemp(prefix='ratify-view-')}/t").saveAsTable(names[name])
    return tag, names


@pytest.fixture(scope="module", params=["fixtures", "driver tables"])
def stored(spark, request):
    if request.param == "fixtures":
        t, kw = FX.tables(spark), {}
    else:
        t = analog_tables(spark, "/root/testdata/sf0.001")
        made = analog_options()
        kw = {"start_date": made.start_date, "threshold_scale": made.threshold_scale}
    return t, kw, *_stored(spark, t)


@pytest.mark.parametrize("variant", VARIANTS)
def test_a_second_session_reads_the_fact_by_name(spark, stored, variant):
    t, kw, tag, names = stored
    opts = FactOptions(**kw, **variant)
    rules = RuleTables.default(spark, opts.threshold_scale, t.customer_rules)
    view = store_fact_view(spark, f"{tag}_fact", names, rules, opts)
    got, want = spark.newSession().table(view), approval_fact(t, rules, opts)
    assert got.columns == want.columns and want.count()
    assert _rows(got) == _rows(want)


def test_what_a_view_cannot_hold_is_refused(spark):
    t = FX.tables(spark)
    rules = RuleTables.default(spark, 1, t.customer_rules)
    with pytest.raises(ValueError, match="catalog names"):
        fact_view_sql({"services": "s"}, rules)
    with pytest.raises(ValueError, match="whole fact"):
        fact_view_sql({n: n for n in [*SOURCE_SCHEMAS, "customer_rules"]}, rules, FactOptions(duplicates="merge"))
