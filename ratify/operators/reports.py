"""Reports over the approval fact.

The original serves these from a BI model (measures, row-level security,
spreadsheets).  Here each is a DataFrame operator over the fact and a
governed parameter table.  Fact rows can repeat an order (faithful partner
price match), so order-level measures first reduce to one row per order.
Rows at the grain of the order (``plans.fact.order_rows``, with ``_n_rows``)
need no reduction: measures of the order take them as they are, measures of
fact rows weigh them with ``_n_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratify.operators.hierarchy import team_names


def _orders(fact: DataFrame, *cols: str) -> DataFrame:
    """One row per order with the order-level columns needed (repeats removed)."""
    if "_n_rows" in fact.columns:
        return fact.select("OrderServiceCode", *cols)
    return fact.select("OrderServiceCode", *cols).dropDuplicates(["OrderServiceCode"])


def month_of(d: Column | str) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return (F.year(d) * 100 + F.month(d)).cast("long")


def sla_attainment(fact: DataFrame, targets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of orders approved within the client's SLA target (business hours).

    Orders without an SLA (decider-only) or without a target are not counted.
    """
    by = by or ["_aprovador"]
    orders = _orders(fact, "CustomerId", "sla_minutos", *[c for c in by if c != "OrderServiceCode"])
    tg = targets.select(F.col("customer_id").alias("_tg_customer"),
                        F.col("target_hours").alias("_tg_hours"))
    j = orders.join(tg, orders["CustomerId"] == tg["_tg_customer"], "inner")
    j = j.filter(F.col("sla_minutos").isNotNull())
    on_time = (F.col("sla_minutos") <= F.col("_tg_hours") * 60).cast("int")
    out = j.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders_with_sla"),
        F.sum(on_time).cast("long").alias("orders_on_time"),
    )
    return out.withColumn("on_time_share",
                          F.col("orders_on_time").cast("double") / F.col("orders_with_sla"))


def approver_summary(fact: DataFrame, hierarchy: DataFrame, grain: str = "month") -> DataFrame:
    """Orders, weight and daily average per consultant, rolled up to the
    supervisor and to the whole period (``rollup``).  grain 'week' or 'month'.
    """
    period = F.col("YearWeek").cast("long") if grain == "week" else month_of("data_aprovacao")
    h = hierarchy.select(F.col("consultant_name").alias("_h_name"),
                         F.col("supervisor_name"))
    # a consultant listed twice reports to the first supervisor by name
    h = h.groupBy("_h_name").agg(F.min("supervisor_name").alias("supervisor_name"))
    one = "_n_rows" in fact.columns
    weight = F.col("peso_os") * F.col("_n_rows") if one else F.col("peso_os")
    rows = fact.select("OrderServiceCode", "_aprovador", "data_aprovacao", weight.alias("peso_os"),
                       period.alias("period"))
    j = rows.join(h, rows["_aprovador"] == h["_h_name"], "left")
    # an order has one approver and one day, so daily counts of distinct orders add up
    daily = j.groupBy("period", "supervisor_name", "_aprovador", "data_aprovacao").agg(
        (F.count if one else F.countDistinct)("OrderServiceCode").alias("day_orders"), F.sum("peso_os").alias("day_weight"))
    out = daily.rollup("period", "supervisor_name", "_aprovador").agg(
        F.sum("day_orders").alias("orders"),
        F.sum("day_weight").alias("soma_peso_os"),
        F.countDistinct("data_aprovacao").alias("approval_days"),
        F.grouping_id().alias("level"),
    )
    return out.withColumn("daily_avg_orders",
                          F.col("orders").cast("double") / F.col("approval_days"))


def average_ticket(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Approved total, order count and average ticket per approver and month."""
    orders = _orders(fact, "_aprovador", "data_aprovacao", "_valor_aprovado", "valor_orcado")
    orders = orders.withColumn("month", month_of("data_aprovacao"))
    by = by or ["_aprovador", "month"]
    out = orders.groupBy(*by).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("valor_orcado").alias("total_orcado"),
        F.sum("_valor_aprovado").alias("total_aprovado"),
    )
    return out.withColumn("ticket_medio", F.col("total_aprovado") / F.col("orders"))


# adherence bands and SLA ranges for the matrix (ours: the original leaves them to the BI layer)
ADHERENCE_BANDS = [("lt50", 0.5), ("p50_80", 0.8), ("ge80", None)]
SLA_RANGES = [("ate_8h", 8 * 60), ("de_8h_a_24h", 24 * 60), ("acima_24h", None)]


def adherence_matrix(fact: DataFrame) -> DataFrame:
    """Order counts by SLA range (rows) x price-adherence band (pivoted columns)."""
    orders = _orders(fact, "sla_minutos", "total_aprovado_referencial", "total_aprovado_aderente")
    ratio = (F.coalesce(F.col("total_aprovado_aderente"), F.lit(0)).cast("double")
             / F.col("total_aprovado_referencial").cast("double"))
    band = F.when(F.col("total_aprovado_referencial").isNull()
                  | (F.col("total_aprovado_referencial") == 0), F.lit("none"))
    for name, upper in ADHERENCE_BANDS:
        band = band.when(ratio < upper, F.lit(name)) if upper is not None else band.otherwise(F.lit(name))
    sla = F.when(F.col("sla_minutos").isNull(), F.lit("sem_sla"))
    for name, upper in SLA_RANGES:
        sla = sla.when(F.col("sla_minutos") <= upper, F.lit(name)) if upper is not None \
            else sla.otherwise(F.lit(name))
    labels = [n for n, _ in ADHERENCE_BANDS] + ["none"]
    out = (orders.select(sla.alias("sla_range"), band.alias("band"))
           .groupBy("sla_range").pivot("band", labels).count())
    return out.select("sla_range", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                                     for c in labels])


def visible_names(hierarchy: DataFrame, email: str) -> DataFrame:
    """Names of the consultants of a signed-in e-mail: its own and those who report to it directly
    (``hierarchy.team_names``: over any number of steps)."""
    mine = hierarchy.filter((F.col("supervisor_email") == email) | (F.col("consultant_email") == email))
    return _names(mine)


def sliced_names(hierarchy: DataFrame, portfolio: str | None = None, supervisor: str | None = None) -> DataFrame:
    """Names of the consultants of a portfolio and / or supervisor."""
    if portfolio:
        hierarchy = hierarchy.filter(F.col("portfolio") == portfolio)
    if supervisor:
        hierarchy = hierarchy.filter(F.col("supervisor_name") == supervisor)
    return _names(hierarchy)


def _names(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.select(F.col("consultant_name").alias("_v_name")).filter(F.col("_v_name").isNotNull()).distinct()


def visible_rows(fact: DataFrame, hierarchy: DataFrame, email: str,
                 admins: list[str] | tuple[str, ...] = (), cascade: bool = True) -> DataFrame:
    """Cascading row security for one signed-in e-mail.

    Administrators see everything; a supervisor sees the approvals of all
    below them, over any number of steps (``cascade=False``: of those who
    report directly); a consultant sees their own.  The visible names are a
    semi-join; no row is read by the driver.  Where the fact is planned for
    one e-mail, ``FactOptions(approvers=team_names(...))`` applies the names
    before items are met.
    """
    if email in admins:
        return fact
    names = (team_names if cascade else visible_names)(hierarchy, email)
    return fact.join(names, fact["_aprovador"] == names["_v_name"], "left_semi")


def audit_cross(fact: DataFrame, audit: DataFrame) -> DataFrame:
    """Per fact order, disallowed amount from the audit table and its
    share of the approved value (audit pre-aggregated per order)."""
    a = audit.groupBy(F.col("OrderServiceCode").alias("_au_order")).agg(
        F.sum("disallowed_amount").alias("valor_glosado"),
        F.count(F.lit(1)).alias("itens_glosados"))
    orders = _orders(fact, "_aprovador", "_valor_aprovado")
    j = orders.join(a, orders["OrderServiceCode"] == a["_au_order"], "left").drop("_au_order")
    return j.select(
        "OrderServiceCode", "_aprovador", "_valor_aprovado",
        F.coalesce(F.col("valor_glosado"), F.lit(0)).alias("valor_glosado"),
        F.coalesce(F.col("itens_glosados"), F.lit(0)).alias("itens_glosados"),
        (F.coalesce(F.col("valor_glosado"), F.lit(0)).cast("double")
         / F.col("_valor_aprovado").cast("double")).alias("share_glosado"),
    )


def period_slice(fact: DataFrame, hierarchy: DataFrame, start: str | None = None,
                 end: str | None = None, portfolio: str | None = None,
                 supervisor: str | None = None) -> DataFrame:
    """Fact rows in [start, end] for a portfolio and/or supervisor."""
    out = fact
    if start:
        out = out.filter(F.col("data_aprovacao") >= F.lit(start).cast("date"))
    if end:
        out = out.filter(F.col("data_aprovacao") <= F.lit(end).cast("date"))
    if portfolio or supervisor:
        names = sliced_names(hierarchy, portfolio, supervisor)
        out = out.join(names, out["_aprovador"] == names["_v_name"], "left_semi")
    return out
