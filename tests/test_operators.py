"""Operators on the hand-built fixtures: each quirk of SURVEY §4.1 has a case."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ratify.operators.attribution import attach_roles, attribute_approver
from ratify.operators.calendar import business_time, worked_days
from ratify.operators.changelog import (
    membership_changes, membership_events, membership_intervals, order_events,
)
from ratify.operators.effort import fanout_multiplicity, interaction_counts, order_item_summary
from ratify.operators.intervals import partner_price_flag
from ratify.operators.adherence import price_adherence
from ratify.plans.fact import FactOptions, RuleTables, approval_fact, attributed_orders, fact_rows
from ratify.sources import rules as R

from tests import fixtures as FX


@pytest.fixture(scope="module")
def t(spark):
    return FX.tables(spark)


def by_key(rows, key="OrderServiceCode"):
    out = {}
    for r in rows:
        out.setdefault(r[key], []).append(r)
    return out


def test_attribution_priority_and_null_branch(spark, t):
    a = by_key(attribute_approver(attach_roles(t.services, t.users)).collect())
    assert a[100][0]._aprovador == "ana" and a[100][0].OS_Aprovada
    assert a[101][0]._aprovador == "bruno"                      # approver 1 external
    assert a[101][0]._data_sla1 == FX.ts(0, 1) and a[101][0]._data_sla2 == FX.ts(0, 3)
    assert a[102][0]._aprovador == "carla"                      # NULL internal flag skipped
    r103 = a[103][0]                                            # decider only
    assert r103._aprovador == "fabio" and not r103.OS_Aprovada and r103._data_sla1 is None
    assert not a[104][0].any_internal                           # nobody internal
    # the winning branch has a NULL timestamp: the date stays NULL (no fall-through)
    assert a[110][0]._aprovador == "ana" and a[110][0].data_aprovacao is None


def test_calendar_roster_and_automatic_filters(spark, t):
    kept = {r.OrderServiceCode for r in attributed_orders(t, FactOptions()).collect()}
    # 102/111 holiday, 104 nobody, 105/106 automatic TRUE/NULL, 107 Saturday off-roster,
    # 109 NULL approver name, 110 NULL winning date
    assert kept == {100, 101, 103, 108, 112, 113}
    loose = {r.OrderServiceCode for r in attributed_orders(t, FactOptions(weekday_policy="none")).collect()}
    assert loose == kept | {107, 109}


def test_start_date_filter(spark, t):
    kept = {r.OrderServiceCode for r in
            attributed_orders(t, FactOptions(start_date="2025-03-04")).collect()}
    assert kept == {103, 108, 112}


def test_changelog_sets_and_events(spark, t):
    ch = {(r.CodigoCliente, r.ts): r for r in membership_changes(t.param_log).collect()}
    first = ch[(901, dt.datetime(2025, 2, 20, 8, 0))]
    assert first.old_set == [] and sorted(first.new_set) == ["20", "30"]
    ev = sorted((r.CodigoCliente, r.approver, r.event_type, r.ts)
                for r in membership_events(membership_changes(t.param_log)).collect())
    assert (901, "20", "REMOVE", dt.datetime(2025, 3, 4, 10, 0)) in ev
    assert all(e[0] in (900, 901) for e in ev)                   # parameter 587 ignored
    assert not any(e[1] == "10" and e[0] == 901 for e in ev)


def test_lead_tie_break_remove_before_add(spark, t):
    rows = order_events(membership_events(membership_changes(t.param_log))).filter(
        (F.col("CodigoCliente") == 901) & (F.col("approver") == "20")).orderBy("ts", "event_type").collect()
    add_first, remove, add_again = rows[0], rows[2], rows[1]
    assert remove.event_type == "REMOVE" and add_again.event_type == "ADD"
    assert add_first.next_ts == dt.datetime(2025, 3, 4, 10, 0) and add_first.next_event_type == "REMOVE"
    assert add_again.next_ts is None                            # REMOVE sorts before ADD on a tie


def test_intervals_add_then_add_and_open_end(spark, t):
    iv = sorted((r.CodigoCliente, r.nome_aprovador, r.DataInicioDate, r.DataFimDate, r.DataInicio, r.DataFim)
                for r in membership_intervals(t.param_log, t.users).collect())
    ana = [x for x in iv if x[0] == 900]
    assert ana == [(900, "ana", dt.date(2025, 3, 1), dt.date(2025, 3, 3), "2025-03-01 08:00", "2025-03-03 08:00"),
                   (900, "ana", dt.date(2025, 3, 3), dt.date(9999, 12, 31), "2025-03-03 08:00", None)]


def test_interval_join_faithful_duplicates_exists_does_not(spark, t):
    base = spark.createDataFrame([(1, 900, "ana", dt.date(2025, 3, 3)), (2, 900, "ana", dt.date(2025, 3, 2)),
                                  (3, 900, None, dt.date(2025, 3, 3)), (4, 901, "bruno", dt.date(2025, 3, 10))],
                                 "OrderServiceCode long, CustomerId long, _aprovador string, data_aprovacao date")
    iv = membership_intervals(t.param_log, t.users)
    span = (dt.date(2025, 2, 1), dt.date(2025, 3, 31))
    f = by_key(partner_price_flag(base, iv, "faithful", span).collect())
    e = by_key(partner_price_flag(base, iv, "exists", span).collect())
    assert len(f[1]) == 2 and all(r.preco_parceiro for r in f[1])   # end day = next start day
    assert len(e[1]) == 1 and e[1][0].preco_parceiro
    assert f[2][0].preco_parceiro and not f[3][0].preco_parceiro      # NULL name never matches
    assert f[4][0].preco_parceiro                                     # open interval
    assert sum(len(v) for v in e.values()) == 4
    # bucketed and unbucketed plans agree
    nb = sorted((r.OrderServiceCode, r.preco_parceiro) for r in partner_price_flag(base, iv, "faithful", None).collect())
    assert nb == sorted((r.OrderServiceCode, r.preco_parceiro) for v in f.values() for r in v)


def test_interactions_distinct_minutes(spark, t):
    ix = {r.order_code: (r.total_revisao, r.total_cotacao) for r in interaction_counts(t.history).collect()}
    assert ix[100] == (1, 1)            # two reviews in one minute count once
    assert 101 not in ix                # other codes only: no row
    assert ix[102] == (0, 3)


def test_fanout_multiplicity(spark, t):
    m = {r._fo_order: r._fo_mult for r in fanout_multiplicity(t.protocols, t.attendances).collect()}
    assert m == {101: 2, 113: 1}


def test_item_summary_and_adherence_levels(spark, t):
    s = {r._it_order: r for r in order_item_summary(t.items, t.labors, R.labor_whitelist_table(spark)).collect()}
    assert s[102]._it_count == 0 and s[102]._it_quoted == D("50.00")   # cancelled only
    assert s[104]._it_count == 51
    assert s[113]._ad_reference == D("27.00") and s[113]._ad_adherent == D("18.00")
    adh = {r.MaintenanceId: r for r in price_adherence(t.items, t.services, t.labors, t.merchants,
                                                       R.labor_whitelist_table(spark)).collect()}
    assert adh[113].total_aprovado_referencial == D("27.00")
    assert 102 not in adh                                # dealership merchant
    assert 105 not in adh                                # automatic approval


def test_business_time(spark, t):
    df = spark.createDataFrame([(1, dt.datetime(2025, 3, 3, 17, 0), dt.datetime(2025, 3, 4, 9, 30)),
                                (2, dt.datetime(2025, 3, 4, 12, 0), dt.datetime(2025, 3, 7, 12, 0)),
                                (3, dt.datetime(2025, 3, 7, 17, 0), dt.datetime(2025, 3, 10, 8, 30)),
                                (4, None, dt.datetime(2025, 3, 10, 8, 30))],
                               "k long, a timestamp, b timestamp")
    got = {r.k: (r.sla_minutes, r.sla_text) for r in business_time(df, "a", "b", t.dates).collect()}
    assert got[1] == (60 + 90, "02:30")
    # Tue 12:00 -> Fri 12:00 skips the Wednesday holiday; Thursday is a bridge day (worked)
    assert got[2] == (360 + 600 + 240, "20:00")
    assert got[3] == (60 + 30, "01:30")                 # over the weekend
    assert got[4] == (None, None)


def test_worked_days_roster_saturday(spark, t):
    pairs = spark.createDataFrame([(202510, "bruno"), (202510, "ana"), (202510, None)],
                                  "YearWeek int, _aprovador string")
    got = {r._aprovador: r.worked_days for r in worked_days(pairs, t.dates, t.roster).collect()}
    assert got == {"bruno": 5, "ana": 4, None: 4}       # Mar 5 is a holiday


def test_fact_values_and_weekly(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    f = by_key(approval_fact(t, rules, FactOptions()).collect())
    assert set(f) == {100, 101, 103, 108, 112, 113}
    r100 = f[100]
    assert len(r100) == 2                                # two intervals hit the approval day
    assert r100[0].peso_os == D("0.09") and r100[0]._monta == "media_monta"
    assert r100[0].total_int_rev == 1 and r100[0].total_int_cot == 1
    assert r100[0].total_aprovado_referencial == D("54.00")   # 27 x 2 fact rows
    r101 = f[101][0]
    assert r101._faixa_qtde_itens == "08-10" and r101.valor_orcado == D("4000.00")  # fan-out x2
    assert r101._monta == "Preventiva" and r101.peso_os == D("0.07")
    assert r101.total_os_semana_aprovador == 2 and r101.total_dias_uteis_semana == 1  # Saturday not a day
    assert r101.soma_peso_os_semana_aprovador == D("0.11")
    r103 = f[103][0]
    assert not r103.OS_Aprovada and r103.sla_aprovocao is None and r103._monta == "alta_monta"
    assert f[112][0]._monta == "Preventiva" and f[112][0]._tipo_manutencao == "Corretiva"
    assert f[113][0].total_aprovado_aderente == D("18.00") and f[113][0]._faixa_qtde_itens == "06-07"
    assert f[113][0].total_dias_uteis_semana == 2 and f[113][0].produtividade_semana_aprovador == D("0.035")


def test_fact_exists_mode_and_view_variant(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    ex = approval_fact(t, rules, FactOptions(price_match="exists")).collect()
    assert len(ex) == 6 and len({r.OrderServiceCode for r in ex}) == 6
    r100 = [r for r in ex if r.OrderServiceCode == 100][0]
    assert r100.total_aprovado_referencial == D("27.00")
    view = approval_fact(t, rules, FactOptions(weekday_policy="none", sla_grain="date")).collect()
    codes = {r.OrderServiceCode for r in view}
    assert {107, 109} <= codes
    nul = [r for r in view if r.OrderServiceCode == 109][0]
    assert nul._aprovador is None and nul.total_dias_uteis_semana is None
    assert isinstance([r for r in view if r.OrderServiceCode == 101][0]._data_sla1, dt.date)


def test_fact_plan_has_no_cartesian_or_python(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    plan = approval_fact(t, rules, FactOptions(persist=False))._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


def test_staged_fact_equals_unstaged_and_reads_the_rows_once(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    staged = approval_fact(t, rules, FactOptions(staged=True, extras=True))
    plain = approval_fact(t, rules, FactOptions(extras=True))
    assert staged.columns == plain.columns
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect()))
    # rows and weekly totals both come from the staged rows: no source is left in the plan
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert "QuotedPrice" not in plan and "Sk_FirstApprover" not in plan


def test_repeat_count_needs_no_window_over_orders(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    plan = fact_rows(t, rules, FactOptions())._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert not any("OrderServiceCode" in line for line in windows)
    with pytest.raises(ValueError):
        fact_rows(t, rules, FactOptions(price_match="other"))


def test_view_whitespace_variant_changes_members(spark, t):
    # ' 20 ; 30,20' -> stripped {20, 30}; unstripped {' 20 ', ' 30', '20'}: '20' still
    # matches bruno, but ' 30' is no user code, so carla's interval loses its name
    def named(strip):
        return {(r.Aprovador, r.nome_aprovador)
                for r in membership_intervals(t.param_log, t.users, strip_whitespace=strip)
                .filter(F.col("CodigoCliente") == 901).collect()}
    assert ("30", "carla") in named(True)
    unstripped = named(False)
    assert (" 30", None) in unstripped and ("20", "bruno") in unstripped
    assert not any(name == "carla" for _, name in unstripped)


def test_ordered_output(spark, t):
    rules = RuleTables.default(spark, 1, t.customer_rules)
    rows = approval_fact(t, rules, FactOptions(order_output=True)).collect()
    keys = [(r._aprovador or "", r.data_aprovacao, r._tipo_manutencao, r._faixa_qtde_itens) for r in rows]
    assert keys == sorted(keys)
