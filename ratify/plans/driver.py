"""Registered queries over the driver tables (see ``ratify.sources.analog``).

Each query takes (spark, sf_dir) and returns a lazy DataFrame whose column
names and value types match the oracle SQL of the same key: decimals are
returned as DOUBLE, dates and timestamps as ISO text, integers as BIGINT.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratify.functions.classify import item_band, maintenance_kind, vehicle_family
from ratify.operators import reports
from ratify.operators.adherence import price_adherence
from ratify.operators.attribution import attach_roles, attribute_approver
from ratify.operators.calendar import business_time, worked_days
from ratify.operators.changes import touched_months, touched_orders
from ratify.operators.changelog import (
    TS_COL, membership_changes, membership_events, membership_intervals, order_events,
)
from ratify.operators.cube import refresh_cube, slice_totals, summary_from_cube
from ratify.operators.effort import (
    extra_minutes, interaction_counts, item_totals, severity, severity_factor, standard_minutes,
)
from ratify.operators.hierarchy import reporting_closure, team_names
from ratify.operators.interval_state import IntervalState
from ratify.operators.intervals import attach_matches, interval_matches
from ratify.operators.person_calendar import CLASSES, PersonCalendar, WorkClass
from ratify.operators.weekly import weekly_days, weekly_summary
from ratify.plans.fact import (
    FactOptions, RuleTables, approval_fact, attributed_orders, calendar_span, fact_rows,
    order_rows, price_intervals, repeated, weighted_orders,
)
from ratify.session import ensure_checkpoint_dir
from ratify.sources import rules as R
from ratify.sources.analog import (
    ANALOG_START_DATE, ANALOG_THRESHOLD_SCALE, analog_assignments, analog_attendances, analog_duplicates, analog_items,
    analog_protocols, analog_reporting,
    analog_services, analog_sheets, analog_supervision, analog_tables, read_driver,
)
from ratify.sources.colocated import read_by_order, write_by_order
from ratify.sources.governed import govern
from ratify.sources.sinks import MONTH_COL, refresh_fact, refresh_months
from ratify.sources.versions import VersionedTable


def normalize(df: DataFrame) -> DataFrame:
    """Cast columns to the comparison types (double / text / bigint)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def analog_options(**kw) -> FactOptions:
    base = dict(start_date=ANALOG_START_DATE, threshold_scale=ANALOG_THRESHOLD_SCALE)
    base.update(kw)
    return FactOptions(**base)


def analog_fact(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    t = analog_tables(spark, sf_dir)
    opts = analog_options(**kw)
    rules = RuleTables.default(spark, opts.threshold_scale, t.customer_rules)
    return approval_fact(t, rules, opts)


def q_approval_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full 28-column fact."""
    return _rounded_fact(analog_fact(spark, sf_dir, staged=True))


def _rounded_fact(df: DataFrame) -> DataFrame:
    return normalize(df.withColumns({
        "media_diaria_os_aprovador": F.round("media_diaria_os_aprovador", 6),
        "produtividade_semana_aprovador": F.round(
            F.col("produtividade_semana_aprovador").cast("double"), 6),
    }))


def q_weekly_productivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C18 at its own grain: one row per (approver, ISO week)."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    out = weekly_summary(order_rows(t, rules, opts))
    return normalize(out.withColumns({
        "soma_peso_os": F.col("soma_peso_os").cast("double"),
        "produtividade_semana_aprovador": F.round(
            F.col("produtividade_semana_aprovador").cast("double"), 6),
    }))


def _tables_rules(spark, sf_dir, **kw):
    t = analog_tables(spark, sf_dir)
    opts = analog_options(**kw)
    return t, RuleTables.default(spark, opts.threshold_scale, t.customer_rules), opts


def _orders_with_items(t) -> DataFrame:
    """Every service order with its item totals (orders without items: count 0)."""
    it = item_totals(t.items)
    s = t.services.join(it, t.services["OrderServiceCode"] == it["_it_order"], "left")
    return s.withColumn("n_items", F.coalesce(F.col("_it_count"), F.lit(0)))


def q_approver_attribution(spark, sf_dir):
    """C2, C3, P14, J7-J10 over every service order."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    a = attribute_approver(attach_roles(t.services, t.users))
    return normalize(a.select("OrderServiceCode", "OS_Aprovada", "any_internal", "_aprovador",
                              "data_aprovacao", "_data_sla1", "_data_sla2"))


def q_business_day_filter(spark, sf_dir):
    """Orders kept on valid approval days."""
    t, _, opts = _tables_rules(spark, sf_dir)
    k = attributed_orders(t, opts)
    return normalize(k.select("OrderServiceCode", "_aprovador", "data_aprovacao", "YearWeek",
                              "WeekDayNumber", "HolidayOrBridge"))


def q_not_in_null_roster(spark, sf_dir):
    """Approvals per approver and weekday with and without the roster rule."""
    t, _, opts = _tables_rules(spark, sf_dir)
    loose = attributed_orders(t, analog_options(weekday_policy="none"))
    strict = attributed_orders(t, opts).select(F.col("OrderServiceCode").alias("_k"))
    j = loose.join(strict, loose["OrderServiceCode"] == strict["_k"], "left")
    out = j.groupBy("_aprovador", "WeekDayNumber").agg(
        F.count(F.lit(1)).alias("approvals_no_rule"),
        F.count("_k").alias("approvals_roster_rule"))
    return normalize(out)


def q_item_bands(spark, sf_dir):
    """Item count band for every order (no items -> 0 -> first band)."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    o = _orders_with_items(t)
    return normalize(o.select("OrderServiceCode", F.col("n_items").cast("long").alias("n_items"),
                              item_band("n_items").alias("_faixa_qtde_itens"),
                              F.col("_it_quoted").alias("valor_os")))


def q_standard_minutes(spark, sf_dir):
    """Maintenance kind x item band -> standard minutes."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    o = _orders_with_items(t).join(t.types, "Sk_MaintenanceType", "left")
    o = o.withColumns({
        "_tipo_manutencao": maintenance_kind("MaintenanceTypeDescription", "MaintenanceType"),
        "_faixa_qtde_itens": item_band("n_items"),
    })
    o = standard_minutes(o, R.standard_minutes_table(spark))
    return normalize(o.select("OrderServiceCode", "_tipo_manutencao", "_faixa_qtde_itens",
                              "tempo_padrao"))


def q_severity(spark, sf_dir):
    """Vehicle family, severity class and factor per order."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    o = (_orders_with_items(t).join(t.types, "Sk_MaintenanceType", "left")
         .join(t.vehicles, "Sk_MaintenanceVehicle", "left"))
    o = o.withColumns({"familia_do_modelo": vehicle_family("maintenancemodelfamily", "familycategory"),
                       "_valor_os": F.col("_it_quoted")})
    o = severity(o, R.severity_threshold_table(spark, ANALOG_THRESHOLD_SCALE))
    o = severity_factor(o, R.severity_factor_table(spark))
    return normalize(o.select("OrderServiceCode", "familia_do_modelo", "_valor_os", "_monta",
                              "fator_correcao_monta"))


def q_interaction_counts(spark, sf_dir):
    """Distinct review / quote minutes per order."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    return normalize(interaction_counts(t.history))


def q_extra_minutes(spark, sf_dir):
    """C11-C14: interaction and public-market extra minutes per order."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    ix = interaction_counts(t.history).select(
        F.col("order_code").alias("_ix"), F.col("total_revisao").alias("total_int_rev"),
        F.col("total_cotacao").alias("total_int_cot"))
    o = _orders_with_items(t).join(t.vehicles, "Sk_MaintenanceVehicle", "left")
    o = o.join(ix, o["OrderServiceCode"] == ix["_ix"], "left")
    o = extra_minutes(o, t.customer_rules)
    return normalize(o.select("OrderServiceCode", "total_int_rev", "total_int_cot",
                              "tempo_extra_revisao", "tempo_extra_cotacao",
                              "tempo_extra_mercadopublico"))


def q_list_set_diff(spark, sf_dir):
    """ADD / REMOVE events from the delimited-list change log."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    ev = membership_events(membership_changes(t.param_log))
    return normalize(ev)


def q_membership_events(spark, sf_dir):
    """Each event with the next event time and type of its (client, member)."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    return normalize(order_events(membership_events(membership_changes(t.param_log))))


def q_membership_intervals(spark, sf_dir):
    """C1 + J13: partner-price intervals with the member's user name."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    return normalize(membership_intervals(t.param_log, t.users))


def q_membership_intervals_by_slices(spark, sf_dir):
    """C1, W1 as kept state: the log arrives in slices by year, one of them late, and each meets only open events."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    state = IntervalState(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/interval-state-{uuid.uuid4().hex}")
    year = F.year(TS_COL)
    for part in (year < 1997, year.isin(1999, 2000), year > 2000):
        state.apply(t.param_log.where(part))
    state.apply(t.param_log.where(year.isin(1997, 1998) | year.isNull()), late="replay")
    return normalize(state.intervals(t.users))


def q_approval_fact_refreshed(spark, sf_dir):
    """C19 through S6: the fact of the rows up to late 2000, brought up to date with later orders and items."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    raw, cut = t.extra, F.lit("2000-10-01").cast("timestamp_ntz")
    old_orders = raw["orders"].where(F.col("o_orderdate") < cut)
    old_items = raw["lineitem"].where(F.col("l_shipdate") < cut)
    before = dataclasses.replace(t, services=analog_services(old_orders), protocols=analog_protocols(old_orders),
                                 items=analog_items(old_items), attendances=analog_attendances(old_items))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fact-{uuid.uuid4().hex}"
    refresh_fact(spark, before, path, opts, rules)
    new_orders, new_items = (raw["orders"].where(~(F.col("o_orderdate") < cut) | F.col("o_orderdate").isNull()),
                             raw["lineitem"].where(~(F.col("l_shipdate") < cut) | F.col("l_shipdate").isNull()))
    touched = touched_orders({"services": analog_services(new_orders), "protocols": analog_protocols(new_orders),
                              "items": analog_items(new_items), "attendances": analog_attendances(new_items)}, t)
    held = spark.read.parquet(path).select("OrderServiceCode", "data_aprovacao")
    refresh_months(spark, t, path, opts, touched_months(touched, t, held), rules)
    return _rounded_fact(spark.read.parquet(path).drop(MONTH_COL))


def q_approval_fact_repeated_keys(spark, sf_dir):
    """Order codes and dimension keys with second rows, merged as the original merges them."""
    t, rules, opts = _tables_rules(spark, sf_dir, staged=True, duplicates="merge")
    return _rounded_fact(approval_fact(analog_duplicates(t), rules, opts))


def q_approval_fact_view_form(spark, sf_dir):
    """C19 as the view form (V2-V4, J14b): no weekday rule, stage days, the price by existence, blanks kept."""
    return _rounded_fact(analog_fact(spark, sf_dir, staged=True, weekday_policy="none", sla_grain="date",
                                     price_match="exists", strip_whitespace=False))


def _interval_join(spark, sf_dir, mode):
    t, _, opts = _tables_rules(spark, sf_dir)
    k = attributed_orders(t, opts).join(t.vehicles.select("Sk_MaintenanceVehicle", "CustomerId"),
                                        "Sk_MaintenanceVehicle", "left")
    k = k.select("OrderServiceCode", "CustomerId", "_aprovador", "data_aprovacao")
    matches = interval_matches(k, price_intervals(t, opts), calendar_span(t.dates))
    flagged = repeated(attach_matches(k, matches, mode))
    return normalize(flagged.select("OrderServiceCode", "CustomerId", "_aprovador",
                                    "data_aprovacao", "preco_parceiro"))


def q_interval_join_faithful(spark, sf_dir):
    """LEFT range join (an approval in two intervals appears twice)."""
    return _interval_join(spark, sf_dir, "faithful")


def q_interval_join_exists(spark, sf_dir):
    """Existence form (one row per approval)."""
    return _interval_join(spark, sf_dir, "exists")


def q_order_weight(spark, sf_dir):
    """Total minutes, factors, daily target and weight."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    return _weights(weighted_orders(t, rules, opts, calendar_span(t.dates)))


def q_order_weight_by_bucket(spark, sf_dir):
    """C16 over order-clustered storage: J6, J12 and their aggregates run bucket by bucket."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    name = f"by_order_{uuid.uuid4().hex}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    write_by_order(t, name, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}", buckets, months=12)
    stored = read_by_order(spark, name, t)
    return _weights(weighted_orders(stored, rules, opts, calendar_span(t.dates)))


def _weights(c: DataFrame) -> DataFrame:
    return normalize(c.select(
        "OrderServiceCode", "preco_parceiro", "tempo_padrao", "tempo_extra_interacao",
        "tempo_extra_mercadopublico", "tempo_total", "fator_correcao_monta",
        "fator_correcao_precoparceiro",
        F.round(F.col("meta_os_dia_corrigido").cast("double"), 6).alias("meta_os_dia_corrigido"),
        "peso_os"))


def _fact(spark, sf_dir, **kw):
    t, rules, opts = _tables_rules(spark, sf_dir, extras=True, **kw)
    return t, approval_fact(t, rules, opts)


def _rows(spark, sf_dir, **kw):
    """The fact at the grain of the order, for reports that do not repeat rows."""
    priced = kw.pop("priced", False)
    t, rules, opts = _tables_rules(spark, sf_dir, **kw)
    return t, order_rows(t, rules, opts, priced=priced)


def q_weekly_distinct_days(spark, sf_dir):
    """Distinct Monday-Friday approval days per (week, approver)."""
    t, _, opts = _tables_rules(spark, sf_dir)
    return normalize(weekly_days(attributed_orders(t, opts)))


def q_window_totals(spark, sf_dir):
    """Weekly sums and counts per fact row, and the daily ratios."""
    _, f = _fact(spark, sf_dir, staged=True)
    return normalize(f.select(
        "OrderServiceCode", "YearWeek", "_aprovador", "preco_parceiro",
        "soma_peso_os_semana_aprovador", "total_os_semana_aprovador",
        "media_diaria_os_aprovador",
        F.round(F.col("produtividade_semana_aprovador").cast("double"), 6)
        .alias("produtividade_semana_aprovador")))


def q_price_adherence(spark, sf_dir):
    """Reference-price adherence per eligible order (all orders)."""
    t = analog_tables(spark, sf_dir, with_calendar=False)
    a = price_adherence(t.items, t.services, t.labors, t.merchants, R.labor_whitelist_table(spark))
    return normalize(a)


def q_business_time(spark, sf_dir):
    """Business minutes between budget and third approval for every order."""
    t = analog_tables(spark, sf_dir)
    s = t.services.select("OrderServiceCode", "FistBudgetSentTimestamp", "ThirdApprovalTimestamp")
    out = business_time(s, "FistBudgetSentTimestamp", "ThirdApprovalTimestamp", t.dates,
                        minutes_col="business_minutes", text_col="business_text")
    return normalize(out.select("OrderServiceCode", "business_minutes", "business_text"))


def q_sla_attainment(spark, sf_dir):
    """On-time share per approver against per-client targets."""
    t, f = _rows(spark, sf_dir)
    return normalize(reports.sla_attainment(f, t.sla_target))


def q_approver_summary(spark, sf_dir):
    """Monthly rollup supervisor -> consultant."""
    t, f = _rows(spark, sf_dir, priced=True)
    out = reports.approver_summary(f, t.hierarchy, grain="month")
    return normalize(out)


def q_average_ticket(spark, sf_dir):
    """Approved total and average ticket per approver and month."""
    _, f = _rows(spark, sf_dir)
    out = reports.average_ticket(f)
    return normalize(out.withColumn("ticket_medio", F.col("total_aprovado").cast("double")
                                    / F.col("orders")))


def q_adherence_matrix(spark, sf_dir):
    """SLA range x adherence band order counts."""
    _, f = _rows(spark, sf_dir, priced=True)
    return normalize(reports.adherence_matrix(f))


def q_row_security(spark, sf_dir):
    """Rows visible to the supervisor of region 1."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    names = reports.visible_names(t.hierarchy, "america@ops.example")
    out = fact_rows(t, rules, dataclasses.replace(opts, approvers=names))
    return normalize(out.select("OrderServiceCode", "_aprovador", "data_aprovacao", "peso_os"))


def q_row_security_cascade(spark, sf_dir):
    """Rows visible over any number of steps, with a circle in the reporting lines."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    reporting = analog_reporting(read_driver(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey"),
                                 read_driver(spark, sf_dir, "region", "r_regionkey", "r_name"))
    out = fact_rows(t, rules, dataclasses.replace(opts, approvers=team_names(reporting, "america@ops.example")))
    return normalize(out.select("OrderServiceCode", "_aprovador", "data_aprovacao", "peso_os"))


def q_reporting_closure(spark, sf_dir):
    """Every pair of the reporting lines with its distance."""
    return normalize(reporting_closure(analog_supervision(read_driver(spark, sf_dir, "supplier", "s_suppkey", "s_name"))))


def q_audit_cross(spark, sf_dir):
    """Disallowed (returned) amounts per approved order."""
    t, f = _rows(spark, sf_dir)
    out = reports.audit_cross(f, t.audit)
    return normalize(out)


def q_period_slice(spark, sf_dir):
    """One portfolio's approvals in 1997."""
    t, rules, opts = _tables_rules(spark, sf_dir)
    year = ((dt.date(1997, 1, 1), dt.date(1997, 12, 31)),)
    out = fact_rows(t, rules, dataclasses.replace(opts, days=year, approvers=reports.sliced_names(t.hierarchy, portfolio="ASIA")))
    return normalize(out.select("OrderServiceCode", "_aprovador", "data_aprovacao", "peso_os",
                                "YearWeek"))


def _cube(spark, sf_dir):
    """The day cube, built whole below the checkpoint folder and read back."""
    t, rows = _rows(spark, sf_dir, priced=True)
    table = VersionedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/day-cube-{uuid.uuid4().hex}")
    refresh_cube(table, rows)
    return t, table.read()


def q_approver_summary_from_cube(spark, sf_dir):
    """The monthly rollup from the day cube."""
    t, cube = _cube(spark, sf_dir)
    return normalize(summary_from_cube(cube, t.hierarchy, "month"))


def q_weekly_summary_from_cube(spark, sf_dir):
    """The weekly rollup from the day cube."""
    t, cube = _cube(spark, sf_dir)
    return normalize(summary_from_cube(cube, t.hierarchy, "week"))


def q_period_totals_from_cube(spark, sf_dir):
    """One portfolio's totals in 1997 by approver, from the day cube."""
    t, cube = _cube(spark, sf_dir)
    return normalize(slice_totals(cube, t.hierarchy, "1997-01-01", "1997-12-31", portfolio="ASIA"))


def q_worked_days(spark, sf_dir):
    """Business days per (week, approver), Saturdays for roster members."""
    t, _, opts = _tables_rules(spark, sf_dir)
    return normalize(worked_days(attributed_orders(t, opts), t.dates, t.roster))


def _person_calendar(t):
    classes = CLASSES | {"late": WorkClass(day_start=600, day_end=1200)}
    return PersonCalendar(t.dates, analog_assignments(t.extra["nation"]), classes)


def q_business_time_by_person(spark, sf_dir):
    """C6 by person: minutes of the SLA stage in the working time of the order's approver."""
    t, _, opts = _tables_rules(spark, sf_dir)
    k = attributed_orders(t, opts).select("OrderServiceCode", "_aprovador", "_data_sla1", "_data_sla2")
    out = _person_calendar(t).business_time(k, "_data_sla1", "_data_sla2", "_aprovador", "business_minutes", "business_text")
    return normalize(out.select("OrderServiceCode", "_aprovador", "business_minutes", "business_text"))


def q_worked_days_by_person(spark, sf_dir):
    """C26 by person: working days of all weeks between an approver's first and last approval."""
    t, _, opts = _tables_rules(spark, sf_dir)
    return normalize(_person_calendar(t).worked_weeks(attributed_orders(t, opts)))


def q_governed_sheets(spark, sf_dir):
    """Sheets with planted faults (see ``analog_sheets``): rows, by what is wrong with them."""
    t = analog_tables(spark, sf_dir)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sheets-{uuid.uuid4().hex}"
    tables = {"services": t.services, "users": t.users, "vehicles": t.vehicles}
    out = []
    for kind, sheet in analog_sheets(t).items():
        checked = govern(sheet, kind, f"{folder}/{kind}", tables)
        rows = checked.accepted.select(F.lit("").alias("faults")).unionByName(
            checked.refused.select(F.array_join(F.array_sort("_faults"), ",").alias("faults")))
        out.append(rows.groupBy("faults").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(kind).alias("kind"), "faults", "n_rows"))
    return normalize(reduce(DataFrame.unionByName, out))


QUERIES = {
    "weekly_productivity": q_weekly_productivity,
    "approval_fact": q_approval_fact,
    "approval_fact_refreshed": q_approval_fact_refreshed,
    "approval_fact_repeated_keys": q_approval_fact_repeated_keys,
    "approval_fact_view_form": q_approval_fact_view_form,
    "approver_attribution": q_approver_attribution,
    "business_day_filter": q_business_day_filter,
    "not_in_null_roster": q_not_in_null_roster,
    "item_bands": q_item_bands,
    "standard_minutes": q_standard_minutes,
    "severity": q_severity,
    "interaction_counts": q_interaction_counts,
    "extra_minutes": q_extra_minutes,
    "list_set_diff": q_list_set_diff,
    "membership_events": q_membership_events,
    "membership_intervals": q_membership_intervals,
    "membership_intervals_by_slices": q_membership_intervals_by_slices,
    "interval_join_faithful": q_interval_join_faithful,
    "interval_join_exists": q_interval_join_exists,
    "order_weight": q_order_weight,
    "order_weight_by_bucket": q_order_weight_by_bucket,
    "weekly_distinct_days": q_weekly_distinct_days,
    "window_totals": q_window_totals,
    "price_adherence": q_price_adherence,
    "business_time": q_business_time,
    "sla_attainment": q_sla_attainment,
    "approver_summary": q_approver_summary,
    "average_ticket": q_average_ticket,
    "adherence_matrix": q_adherence_matrix,
    "row_security": q_row_security,
    "row_security_cascade": q_row_security_cascade,
    "reporting_closure": q_reporting_closure,
    "audit_cross": q_audit_cross,
    "period_slice": q_period_slice,
    "approver_summary_from_cube": q_approver_summary_from_cube,
    "weekly_summary_from_cube": q_weekly_summary_from_cube,
    "period_totals_from_cube": q_period_totals_from_cube,
    "worked_days": q_worked_days,
    "business_time_by_person": q_business_time_by_person,
    "worked_days_by_person": q_worked_days_by_person,
    "governed_sheets": q_governed_sheets,
}
