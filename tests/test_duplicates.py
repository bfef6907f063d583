"""Repeated order codes and dimension keys, merged as the original's GROUP BY and DISTINCT merge them."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from ratify.plans.fact import FactOptions, RuleTables, approval_fact

from tests import fixtures as FX


@pytest.fixture(scope="module")
def t(spark):
    return FX.tables(spark)


def _fact(t, **kw):
    return approval_fact(t, RuleTables.default(t.services.sparkSession, 1, t.customer_rules), FactOptions(**kw))


def _rows(df):
    return sorted(str(tuple(r)) for r in df.select(*[
        F.col(f.name).cast("double") if "decimal" in f.dataType.simpleString() else F.col(f.name)
        for f in sorted(df.schema.fields, key=lambda f: f.name)]).collect())


def _again(df, condition, **changed):
    return df.unionByName(df.where(condition).withColumns({c: F.lit(v).cast(df.schema[c].dataType) for c, v in changed.items()}))


def test_unique_keys_give_the_same_fact(t):
    for kw in ({}, {"price_match": "exists", "sla_grain": "date", "weekday_policy": "none"}):
        plain, merged = _fact(t, **kw), _fact(t, duplicates="merge", **kw)
        assert plain.columns == merged.columns and _rows(plain) == _rows(merged)


def test_an_exact_repeat_doubles_the_sums_and_not_the_rows(t):
    """Order 113 stands twice, and the vehicle of order 101."""
    once = {r.OrderServiceCode: r for r in _fact(t, duplicates="merge").collect()}
    twice = dataclasses.replace(t, services=_again(t.services, "OrderServiceCode = 113"),
                                vehicles=_again(t.vehicles, "Sk_MaintenanceVehicle = 2"))
    rows = _fact(twice, duplicates="merge").collect()
    assert sum(r.OrderServiceCode == 113 for r in rows) == 1
    got = {r.OrderServiceCode: r for r in rows}
    assert got[113].valor_orcado == 2 * once[113].valor_orcado
    assert got[113].total_aprovado_referencial == 2 * once[113].total_aprovado_referencial  # the order meets its items twice
    assert got[101].valor_orcado == 2 * once[101].valor_orcado                                # by its vehicle
    assert got[101].total_aprovado_referencial == once[101].total_aprovado_referencial        # the vehicle is not in that join
    assert got[100].valor_orcado == once[100].valor_orcado


def test_rows_that_differ_stay_apart(t):
    """A second name for an approver gives a second row; the order's adherence counts both."""
    two = dataclasses.replace(t, users=_again(t.users, "Sk_WebUser = 7", WebUserName="fabio b"))
    once = {r.OrderServiceCode: r for r in _fact(t, duplicates="merge").collect()}
    rows = [r for r in _fact(two, duplicates="merge").collect() if r.OrderServiceCode == 113]
    assert sorted(r._aprovador for r in rows) == ["fabio", "fabio b"]
    assert {r.total_aprovado_referencial for r in rows} == {2 * once[113].total_aprovado_referencial}
    assert {r.valor_orcado for r in rows} == {once[113].valor_orcado}


def test_what_the_select_leaves_out_is_no_difference(t):
    """A losing approver's second flag splits the groups, and the DISTINCT joins them again if nothing else differs."""
    flags = dataclasses.replace(t, users=_again(t.users, "Sk_WebUser = 4", IsInternalUser=None))
    rows = _fact(flags, duplicates="merge").collect()
    assert len(rows) == len(_fact(t, duplicates="merge").collect())


def test_labors_and_merchants_count_for_adherence_alone(t):
    once = {r.OrderServiceCode: r for r in _fact(t, duplicates="merge").collect()}
    more = dataclasses.replace(t, labors=_again(t.labors, "Sk_MaintenanceLabor = 1"),
                               merchants=_again(t.merchants, "Sk_MaintenanceMerchant = 1"))
    got = {r.OrderServiceCode: r for r in _fact(more, duplicates="merge").collect()}
    assert got[113].total_aprovado_referencial == 4 * once[113].total_aprovado_referencial
    assert got[113].valor_orcado == once[113].valor_orcado and got[113].peso_os == once[113].peso_os


def test_an_unknown_policy_is_refused(t):
    with pytest.raises(ValueError, match="duplicate"):
        _fact(t, duplicates="first")


def test_user_rows_are_counted_before_they_meet_the_orders(t):
    """Exact repeats and second names of losing users make no further rows, and each row knows how many it stands for."""
    from ratify.operators.attribution import attach_merged_roles, attach_roles, attribute_approver

    users = _again(_again(_again(t.users, "Sk_WebUser in (2, 4)"), "Sk_WebUser = 3", WebUserName="carla b"), "Sk_WebUser = 4",
                   IsInternalUser=None)
    columns = ["OrderServiceCode", *[f"{r}_internal" for r in ("a1", "a2", "a3", "dec")], "_aprovador"]
    each, merged = (attribute_approver(attach(t.services, users)) for attach in (attach_roles, attach_merged_roles))
    count = lambda df, n: sorted(str(tuple(r)) for r in df.groupBy(*columns).agg(n).collect())
    assert count(merged, F.sum("_role_rows")) == count(each, F.count(F.lit(1)))
    assert merged.count() == each.select(*columns).distinct().count() < each.count()


def test_merged_orders_are_attributed_with_fewer_rows(t):
    from ratify.plans.fact import attributed_orders

    twice = dataclasses.replace(t, users=_again(t.users, "true"))
    for duplicates in ({}, {"Sk_WebUser = 4": {"WebUserName": "dario b"}}):
        for condition, changed in duplicates.items():
            twice = dataclasses.replace(twice, users=_again(twice.users, condition, **changed))
        assert attributed_orders(twice, FactOptions(duplicates="merge")).count() == attributed_orders(t, FactOptions()).count()
