"""The approval fact (C19): one row per approved order, weighted, with weekly totals.

Plan shape (all lazy DataFrames; Catalyst/AQE pick the physical strategy):

    services --filter(not automatic)--> x users (4 roles) --> attribution
      --> x calendar (broadcast, bounded) --filter(start date, holidays, weekday/roster)
      --> x status / vehicle with customer classes / type / merchant dims --> SLA
      --> x item totals  (pre-aggregated per order, partial agg map-side)
      --> x fan-out multiplicity (protocols x attendances, pre-aggregated)
      --> x interaction counts (history, de-duplicated per minute, pre-aggregated)
      --> classification --> extra minutes
      = base (one row per order)
    order keys x partner-price intervals (year-bucketed range join) --> matches per order
    base x matches --> weight, one row per match  = calc
    calc --aggregate--> weekly totals --join back-->  (no hot window partition)
    --> 28 output columns

The rows feed two branches (weekly totals and the row stream).  With
``staged=True`` they are written once to the shared folder of
``spark.checkpoint.dir`` and both branches read them back, so items and orders
are scanned once for both, and so are the totals, whose size Spark then knows;
the caller's deployment clears that folder (a refresh clears its own).
Without it each branch plans its own pruned subtree: right for queries that
need few columns.  ``persist=True`` caches the rows instead (memory and disk;
lost blocks are recomputed from lineage).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratify.functions.classify import is_true, maintenance_kind, vehicle_family
from ratify.operators.adherence import merchant_ok, merchant_rows
from ratify.operators.attribution import attach_merged_roles, attach_roles, attribute_approver, weekday_filter
from ratify.operators.calendar import business_time, is_approval_day, known_span
from ratify.operators.changelog import member_code, membership_intervals
from ratify.operators.effort import (
    classify_order, customer_classes, extra_minutes, fanout_multiplicity, interaction_counts, order_item_summary,
    weigh,
)
from ratify.operators.intervals import (
    attach_matches, attach_matches_by_key, interval_matches, interval_matches_by_key,
)
from ratify.operators.weekly import attach_weekly, weekly_totals
from ratify.session import ensure_checkpoint_dir
from ratify.sources import rules as R
from ratify.sources.catalog import Tables
from ratify.sources.colocated import in_period

APPROVAL_TIMESTAMPS = ["FirstApprovalTimestamp", "SecondApprovalTimestamp", "ThirdApprovalTimestamp",
                       "DisapprovalTimestamp"]

OUTPUT_COLUMNS = [
    "_aprovador", "OrderServiceCode", "OS_Aprovada", "CustomerId", "IsExternalApproval",
    "valor_orcado", "_valor_aprovado", "total_aprovado_referencial", "total_aprovado_aderente",
    "data_aprovacao", "YearWeek", "sla_aprovocao", "_data_sla1", "_data_sla2",
    "_tipo_manutencao", "_faixa_qtde_itens", "familia_do_modelo", "_monta",
    "total_int_rev", "total_int_cot", "peso_os", "StatusTypeDescription", "preco_parceiro",
    "soma_peso_os_semana_aprovador", "total_os_semana_aprovador", "total_dias_uteis_semana",
    "media_diaria_os_aprovador", "produtividade_semana_aprovador",
]


@dataclass
class FactOptions:
    """Variant switches (the three original forms differ only in these)."""

    start_date: str = R.DEFAULT_START_DATE
    weekday_policy: str = "roster"       # 'roster' (table/script forms) | 'none' (view form)
    sla_grain: str = "timestamp"         # 'timestamp' | 'date' (view form)
    price_match: str = "faithful"        # 'faithful' (LEFT JOIN, may duplicate) | 'exists'
    item_fanout: str = "faithful"        # 'faithful' (protocol x attendance multiply items) | 'dedup'
    strip_whitespace: bool = True        # False = the view's never-matching whitespace pattern
    threshold_scale: int = 1
    persist: bool = False
    staged: bool | str = False           # write rows and weekly totals once (below a folder given), join what is read back
    order_output: bool = False           # final ORDER BY of the table form
    extras: bool = False                 # also return the intermediate measures below
    duplicates: str = "unique"           # keys of orders and dimensions: 'unique' | 'merge' (see ``merged_base``)
    days: tuple = ()                     # (first, last) approval-day ranges, whole weeks; () = all days
    approvers: DataFrame | None = None   # names to keep (one column, distinct), before items are met


@dataclass
class RuleTables:
    thresholds: DataFrame
    factors: DataFrame
    minutes: DataFrame
    customer_rules: DataFrame
    labor_whitelist: DataFrame

    @classmethod
    def default(cls, spark: SparkSession, threshold_scale: int = 1,
                customer_rules: DataFrame | None = None) -> "RuleTables":
        return cls(
            thresholds=R.severity_threshold_table(spark, threshold_scale),
            factors=R.severity_factor_table(spark),
            minutes=R.standard_minutes_table(spark),
            customer_rules=customer_rules if customer_rules is not None
            else R.customer_rule_table(spark),
            labor_whitelist=R.labor_whitelist_table(spark),
        )


    def with_sheets(self, sheets: dict[str, DataFrame]) -> "RuleTables":
        """These rules with the governed sheets given (``sources.governed.SHEETS`` kinds) in their place."""
        unknown = set(sheets) - {f.name for f in fields(self)}
        if unknown:
            raise ValueError(f"no rules of kind {sorted(unknown)}")
        return replace(self, **sheets)


def calendar_span(dates: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last calendar day: known for generated calendars, else one
    scalar aggregate over the (bounded) calendar table."""
    span = known_span(dates)
    if span is not None:
        return span
    row = dates.agg(F.min("ReferenceDate").alias("lo"), F.max("ReferenceDate").alias("hi")).first()
    return row["lo"], row["hi"]


def first_day(opts: FactOptions) -> dt.date:
    """The first day on which an order can count."""
    start = dt.date.fromisoformat(opts.start_date)
    return max(start, min(low for low, _ in opts.days)) if opts.days else start


def attributed_orders(t: Tables, opts: FactOptions) -> DataFrame:
    """Orders with a winning internal approver on a valid approval day."""
    s = in_period(t.services, first_day(opts)).filter(F.col("IsAutomaticApproval") == F.lit(False))
    # the approval day is the day of one of four timestamps: orders with none from the
    # start date on cannot qualify, and this much of the filter reaches the scan
    s = s.filter(reduce(lambda a, b: a | b, [
        F.col(c) >= F.lit(opts.start_date).cast(s.schema[c].dataType) for c in APPROVAL_TIMESTAMPS]))
    if opts.days:
        s = s.filter(reduce(lambda a, b: a | b, [
            F.to_date(c).between(F.lit(low), F.lit(high)) for c in APPROVAL_TIMESTAMPS for low, high in opts.days]))
    attach = attach_merged_roles if opts.duplicates == "merge" else attach_roles
    s = attribute_approver(attach(s, t.users), opts.sla_grain).filter(F.col("any_internal"))
    if opts.days:
        s = s.filter(reduce(lambda a, b: a | b, [
            F.col("data_aprovacao").between(F.lit(low), F.lit(high)) for low, high in opts.days]))
    if opts.approvers is not None:
        s = s.join(opts.approvers.toDF("_kept_name"), F.col("_aprovador") == F.col("_kept_name"), "left_semi")
    cal = t.dates.select("ReferenceDate", "YearWeek", "WeekDayNumber", "HolidayOrBridge")
    s = s.join(F.broadcast(cal), s["data_aprovacao"] == cal["ReferenceDate"], "inner")
    s = s.filter((F.col("ReferenceDate") >= F.lit(opts.start_date).cast("date"))
                 & is_approval_day("HolidayOrBridge"))
    return weekday_filter(s, t.roster, opts.weekday_policy)


def _with_measures(s: DataFrame, t: Tables, rules: RuleTables, opts: FactOptions) -> DataFrame:
    """Add the 1:N sides, each pre-aggregated to one row per order, and ``_fan``: how often the original
    repeats the order's items."""
    # of stored periods (see ``sources.colocated``) only those that can hold such orders are read
    first = first_day(opts)
    items = order_item_summary(in_period(t.items, first), t.labors, rules.labor_whitelist,
                               repeated_labors=opts.duplicates == "merge")
    s = s.join(items, s["OrderServiceCode"] == items["_it_order"], "left")
    if opts.item_fanout == "faithful":
        mult = fanout_multiplicity(in_period(t.protocols, first), t.attendances)
        s = s.join(mult, s["OrderServiceCode"] == mult["_fo_order"], "left")
        m = F.coalesce(F.col("_fo_mult"), F.lit(1))
    else:
        m = F.lit(1)
    inter = interaction_counts(in_period(t.history, first)).select(
        F.col("order_code").alias("_ix_order"), F.col("total_revisao").alias("total_int_rev"),
        F.col("total_cotacao").alias("total_int_cot"))
    return s.join(inter, s["OrderServiceCode"] == inter["_ix_order"], "left").withColumn("_fan", m)


def _with_totals(s: DataFrame, times) -> DataFrame:
    return s.withColumns({
        "_valor_os": F.col("_it_quoted") * times,
        "_valor_aprovado": F.col("_it_approved") * times,
        "n_items": F.coalesce(F.col("_it_count"), F.lit(0)) * times,
    })


def _with_dimensions(s: DataFrame, t: Tables, rules: RuleTables) -> DataFrame:
    """Status, vehicle, its customer's classes and type; the classes meet the vehicles, which are fewer than the orders."""
    s = s.join(t.statuses, "Sk_ServiceOrderStatusType", "left")
    s = s.join(customer_classes(t.vehicles, rules.customer_rules), "Sk_MaintenanceVehicle", "left")
    return s.join(t.types, "Sk_MaintenanceType", "left")


def order_base(t: Tables, rules: RuleTables, opts: FactOptions) -> DataFrame:
    """CTE_BASE: one row per attributed order with effort, class and SLA."""
    if opts.duplicates not in ("unique", "merge"):
        raise ValueError(f"unknown policy for duplicate keys {opts.duplicates!r}")
    if opts.duplicates == "merge":
        return merged_base(t, rules, opts)
    # the dimensions first: they deal narrow rows by their keys, and from the join with the items
    # on the rows stay dealt by order, as the partner-price matches need them
    s = _with_dimensions(attributed_orders(t, opts), t, rules)
    s = s.join(t.merchants.select("Sk_MaintenanceMerchant", "NameMerchantsTypes"),
               "Sk_MaintenanceMerchant", "left")
    s = _with_sla(s, t)
    s = _with_totals(_with_measures(s, t, rules, opts), F.col("_fan")).drop("_fan")
    s = classify_order(s, rules.thresholds, rules.factors, rules.minutes)
    return extra_minutes(s, rules.customer_rules)


def _with_sla(s: DataFrame, t: Tables) -> DataFrame:
    """SLA stage in business time, from the raw timestamps."""
    sla_start = sla_stage_ts(1)
    sla_end = sla_stage_ts(2)
    s = s.withColumns({"_sla_t1": sla_start, "_sla_t2": sla_end})
    s = business_time(s, "_sla_t1", "_sla_t2", t.dates, minutes_col="sla_minutos",
                      text_col="sla_aprovocao")
    return s.drop("_sla_t1", "_sla_t2")


#: What the original groups its base by; the rest of a joined row does not tell two groups apart.
GROUP_COLUMNS = ["OrderServiceCode", "a1_internal", "a2_internal", "a3_internal", "IsExternalApproval", "OS_Aprovada",
                 "_aprovador", "_tipo_manutencao", "familia_do_modelo", "MaintenanceType", "data_aprovacao", "YearWeek",
                 "WeekDayNumber", "HolidayOrBridge", "total_int_rev", "total_int_cot", "_data_sla1", "_data_sla2",
                 "sla_minutos", "sla_aprovocao", "StatusTypeDescription", "CustomerId"]
#: What its DISTINCT then compares: of the grouping not the flags and the type.
DISTINCT_COLUMNS = [c for c in GROUP_COLUMNS if not c.endswith("_internal") and c != "MaintenanceType"] + [
    "_valor_os", "_valor_aprovado", "_faixa_qtde_itens", "tempo_padrao", "_monta", "fator_correcao_monta",
    "tempo_extra_revisao", "tempo_extra_cotacao", "tempo_extra_mercadopublico", "total_interacoes",
    "tempo_extra_interacao"]


def merged_base(t: Tables, rules: RuleTables, opts: FactOptions) -> DataFrame:
    """CTE_BASE where order codes and the keys of users, vehicles, types, statuses, labors and merchants
    may repeat (G6, O4): the joined rows are merged as the original's GROUP BY and DISTINCT merge them.

    Rows that agree on the grouping become one whose item sums and counts are those of the order times
    the rows merged; rows that differ in it stay apart.  The items were aggregated by order before, so
    a group counts its rows instead of meeting the items again, and both aggregates run on rows that
    the join with the items has dealt by order already.  Equal rows of users, statuses and types are
    counted before they meet the orders (see ``attach_merged_roles``).  An order of several base rows has a partner
    price for each (customer, approver, day) of them.  Calendar days are unique.
    """
    statuses, types = (d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias(n)) for d, n in (
        (t.statuses.select("Sk_ServiceOrderStatusType", "StatusTypeDescription"), "_status_rows"),
        (t.types.select("Sk_MaintenanceType", "MaintenanceType"), "_type_rows")))
    s = _with_dimensions(attributed_orders(t, opts), replace(t, statuses=statuses, types=types), rules)
    rows = reduce(lambda a, b: a * b, [F.coalesce(c, F.lit(1)) for c in ("_role_rows", "_status_rows", "_type_rows")])
    s = s.withColumns({
        "_rows": rows,
        "_tipo_manutencao": maintenance_kind("MaintenanceTypeDescription", "MaintenanceType"),
        "familia_do_modelo": vehicle_family("maintenancemodelfamily", "familycategory")})
    s = _with_measures(_with_sla(s, t), t, rules, opts)
    sums = ["_it_quoted", "_it_approved", "_it_count", "_ad_reference", "_ad_adherent", "_fan"]
    # the classes follow from the customer
    s = s.groupBy(*GROUP_COLUMNS, "_cr_quote_class", "_cr_market_class", *sums).agg(F.sum("_rows").alias("_merged"))
    s = _with_totals(s, F.col("_fan") * F.col("_merged"))
    s = extra_minutes(classify_order(s, rules.thresholds, rules.factors, rules.minutes), rules.customer_rules)
    s = s.groupBy(*DISTINCT_COLUMNS, "_ad_reference", "_ad_adherent").agg(F.min("n_items").alias("n_items"))
    merchants = merchant_rows(t.services, t.merchants)
    return s.join(merchants, s["OrderServiceCode"] == merchants["_mr_order"], "left").drop("_mr_order")


def sla_stage_ts(stage: int):
    """Raw SLA stage timestamps (before any DATE cast of the view form)."""
    i1, i2, i3 = (is_true(f"{r}_internal") for r in ("a1", "a2", "a3"))
    cols = (["FistBudgetSentTimestamp", "FirstApprovalTimestamp", "SecondApprovalTimestamp"]
            if stage == 1 else
            ["FirstApprovalTimestamp", "SecondApprovalTimestamp", "ThirdApprovalTimestamp"])
    return F.when(i1, F.col(cols[0])).when(i2, F.col(cols[1])).when(i3, F.col(cols[2]))


def price_intervals(t: Tables, opts: FactOptions) -> DataFrame:
    """C1 of the clients and members that an approval can match.

    No order matches a null client; said of the log itself, both uses of the dealt events have one plan,
    which runs once.  An approval bears the name of an internal user, so members of other names match none.
    """
    u = t.users.select("IsInternalUser", "WebUserName", member_code().alias("_code"))
    internal = u.where(is_true("IsInternalUser")).select("WebUserName").distinct()
    members = u.join(internal, "WebUserName", "left_semi").where(F.col("_code").isNotNull()).select("_code").distinct()
    return membership_intervals(t.param_log.where(F.col("ClientId").isNotNull()), t.users,
                                strip_whitespace=opts.strip_whitespace, members=members)


def approval_span(opts: FactOptions, span: tuple[dt.date, dt.date] | None) -> tuple[dt.date, dt.date] | None:
    """The part of the calendar span on which an order can count (one day of it if there is none)."""
    if span is None:
        return None
    low, high = max(span[0], first_day(opts)), span[1]
    if opts.days:
        high = min(high, max(last for _, last in opts.days))
    return low, max(low, high)


def priced_orders(t: Tables, rules: RuleTables, opts: FactOptions,
                  span: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """CTE_CALC at the grain of the order: base x partner-price intervals, then the weight.

    The intervals are matched on the orders' keys alone; the wide rows meet only
    the match counts, by order code, by which they are already dealt.
    ``_n_rows`` says how often the faithful form has the order (once for each
    match, at least once).
    """
    if opts.price_match not in ("faithful", "exists"):
        raise ValueError(f"unknown price match mode {opts.price_match!r}")
    intervals, span = price_intervals(t, opts), approval_span(opts, span)
    keys = attributed_orders(t, opts).join(
        t.vehicles.select("Sk_MaintenanceVehicle", "CustomerId"), "Sk_MaintenanceVehicle", "left").select(
        "OrderServiceCode", "CustomerId", "_aprovador", "data_aprovacao")
    base = order_base(t, rules, opts)
    if opts.duplicates == "unique":
        return weigh(attach_matches(base, interval_matches(keys, intervals, span), opts.price_match))
    calc = weigh(attach_matches_by_key(base, interval_matches_by_key(keys, intervals, span), opts.price_match))
    # an order's items meet all rows of the order
    return calc.withColumn("_order_rows", F.sum("_n_rows").over(Window.partitionBy("OrderServiceCode")))


def repeated(rows: DataFrame) -> DataFrame:
    """Each row ``_n_rows`` times (the column stays)."""
    return rows.withColumn("_repeat", F.explode(F.sequence(F.lit(1).cast("long"), "_n_rows"))).drop("_repeat")


def weighted_orders(t: Tables, rules: RuleTables, opts: FactOptions,
                    span: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """CTE_CALC: the priced orders, in the faithful form once for each match."""
    rows = priced_orders(t, rules, opts, span)
    return repeated(rows) if opts.price_match == "faithful" else rows


EXTRA_COLUMNS = ["sla_minutos", "tempo_total", "fator_correcao_monta",
                 "fator_correcao_precoparceiro", "meta_os_dia_corrigido", "WeekDayNumber",
                 "HolidayOrBridge", "NameMerchantsTypes", "n_items"]


def _resolve(t: Tables, rules: RuleTables | None, opts: FactOptions | None,
             spark: SparkSession | None) -> tuple[RuleTables, FactOptions]:
    opts = opts or FactOptions()
    if rules is None:
        spark = spark or t.services.sparkSession
        rules = RuleTables.default(spark, opts.threshold_scale, t.customer_rules)
    return rules, opts


def order_rows(t: Tables, rules: RuleTables | None = None, opts: FactOptions | None = None,
               spark: SparkSession | None = None, priced: bool = True) -> DataFrame:
    """The fact at the grain of the order, before the weekly totals, with ``_n_rows``: how often the fact
    has the order.  Reports read this; they count with ``_n_rows`` instead of repeating rows.

    ``priced=False`` leaves out what depends on the partner price (weight, flag, adherence totals, which
    the fact multiplies by the repeats), and with it the change log and the range join; ``_n_rows`` is 1.
    """
    rules, opts = _resolve(t, rules, opts, spark)
    if not priced:
        return order_base(t, rules, opts).withColumns({"valor_orcado": F.col("_valor_os"), "_n_rows": F.lit(1).cast("long")})
    calc = priced_orders(t, rules, opts, calendar_span(t.dates))
    # the original inner-joins items to every fact row of the order, so
    # each order's adherence sums are multiplied by its row count
    if opts.duplicates == "merge":
        r = F.col("_order_rows") * F.col("_merchant_rows")  # null without an eligible merchant
        return calc.withColumns({
            "valor_orcado": F.col("_valor_os"),
            "total_aprovado_referencial": F.col("_ad_reference") * r,
            "total_aprovado_aderente": F.col("_ad_adherent") * r,
        }).drop("_order_rows", "_merchant_rows")
    r = F.col("_n_rows")
    # adherence counts only orders from a non-dealership (automatic ones are
    # already excluded from the fact)
    ok = merchant_ok(F.col("NameMerchantsTypes"))
    return calc.withColumns({
        "valor_orcado": F.col("_valor_os"),
        "total_aprovado_referencial": F.when(ok, F.col("_ad_reference") * r),
        "total_aprovado_aderente": F.when(ok, F.col("_ad_adherent") * r),
    })


def fact_rows(t: Tables, rules: RuleTables | None = None, opts: FactOptions | None = None,
              spark: SparkSession | None = None) -> DataFrame:
    """Fact rows before the weekly totals: every per-order column of the fact
    (``valor_orcado`` and the adherence totals included), an order as often as the fact has it."""
    rules, opts = _resolve(t, rules, opts, spark)
    rows = order_rows(t, rules, opts)
    if opts.persist:
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    return (repeated(rows) if opts.price_match == "faithful" else rows).drop("_n_rows")


def stage_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fact-rows-{uuid.uuid4().hex}"


def _stage(rows: DataFrame, path: str) -> DataFrame:
    """Write ``rows`` and read them back."""
    spark = rows.sparkSession
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def approval_fact(t: Tables, rules: RuleTables | None = None,
                  opts: FactOptions | None = None, spark: SparkSession | None = None) -> DataFrame:
    """The 28-column approval fact."""
    rules, opts = _resolve(t, rules, opts, spark)
    rows = fact_rows(t, rules, opts)
    columns = [*OUTPUT_COLUMNS, *(EXTRA_COLUMNS if opts.extras else [])]
    if opts.staged:
        folder = opts.staged if isinstance(opts.staged, str) else stage_folder(rows.sparkSession)
        rows = _stage(rows.select(*dict.fromkeys(
            c for c in [*columns, "WeekDayNumber", "HolidayOrBridge"] if c in rows.columns)), f"{folder}/rows")
        # stored, the totals have a known size: Spark broadcasts them while they are few, and the rows stay where they are
        weekly = _stage(weekly_totals(rows), f"{folder}/weekly")
    else:
        weekly = weekly_totals(rows)
    rows = attach_weekly(rows, weekly)
    out = rows.select(*columns)
    if opts.order_output:
        out = out.orderBy("_aprovador", "data_aprovacao", "_tipo_manutencao", "_faixa_qtde_itens")
    return out
