"""Weekly approver totals.

The original uses window functions partitioned by (week, approver).  A window
puts a whole partition in one task, and one approver-week may hold a large
share of all rows, so here the totals are an aggregate (partial per map task,
no hot partition) joined back on the same keys; adaptive execution
broadcasts the small totals at run time or splits a skewed key.

Semantics kept from the original:
* sums and counts include every row of the week (Saturday work too), and a
  NULL approver forms its own group, as a window partition does;
* the day denominator counts distinct approval dates Monday-Friday that are
  not holidays; it is NULL when there are none, and always NULL for a NULL
  approver (an equality join never matches NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.operators.calendar import is_approval_day
from ratify.sources import rules as R


def weekly_totals(calc: DataFrame, week_col: str = "YearWeek",
                  approver_col: str = "_aprovador") -> DataFrame:
    """(week, approver) -> soma_peso_os_semana_aprovador, total_os_semana_aprovador,
    total_dias_uteis_semana.

    Two-level aggregate: first per (week, approver, date), then per (week,
    approver); both levels aggregate partially before their shuffle and no
    COUNT(DISTINCT) expansion is needed.
    """
    workday = (F.col("WeekDayNumber") <= R.LAST_WEEKDAY) & is_approval_day("HolidayOrBridge")
    per_day = calc.groupBy(week_col, approver_col, "data_aprovacao").agg(
        F.sum("peso_os").alias("_w_peso"),
        F.count("OrderServiceCode").alias("_w_os"),
        F.max(workday.cast("int")).alias("_w_workday"),
    )
    per_week = per_day.groupBy(week_col, approver_col).agg(
        F.sum("_w_peso").alias("soma_peso_os_semana_aprovador"),
        F.sum("_w_os").cast("long").alias("total_os_semana_aprovador"),
        F.sum(F.when((F.col("_w_workday") == 1) & F.col("data_aprovacao").isNotNull(), 1)
              .otherwise(0)).cast("long").alias("_w_days"),
    )
    days = F.when(F.col(approver_col).isNull() | F.col(week_col).isNull()
                  | (F.col("_w_days") == 0), F.lit(None).cast("long")).otherwise(F.col("_w_days"))
    return per_week.withColumn("total_dias_uteis_semana", days).drop("_w_days")


def weekly_days(orders: DataFrame, week_col: str = "YearWeek", approver_col: str = "_aprovador") -> DataFrame:
    """(week, approver) -> total_dias_uteis_semana, from attributed orders alone (no items, no weights)."""
    workday = (F.col("WeekDayNumber") <= R.LAST_WEEKDAY) & is_approval_day("HolidayOrBridge")
    per_day = orders.groupBy(week_col, approver_col, "data_aprovacao").agg(F.max(workday.cast("int")).alias("_w_workday"))
    worked = F.when((F.col("_w_workday") == 1) & F.col("data_aprovacao").isNotNull()
                    & F.col(approver_col).isNotNull() & F.col(week_col).isNotNull(), 1)
    return per_day.groupBy(week_col, approver_col).agg(
        F.sum(worked).cast("long").alias("total_dias_uteis_semana"))  # null where no day counts


def attach_weekly(calc: DataFrame, weekly: DataFrame, week_col: str = "YearWeek",
                  approver_col: str = "_aprovador") -> DataFrame:
    """Join the weekly totals back and derive the two daily ratios."""
    w = weekly.select(F.col(week_col).alias("_wk_week"), F.col(approver_col).alias("_wk_appr"),
                      "soma_peso_os_semana_aprovador", "total_os_semana_aprovador",
                      "total_dias_uteis_semana")
    cond = calc[week_col].eqNullSafe(w["_wk_week"]) & calc[approver_col].eqNullSafe(w["_wk_appr"])
    keep = calc.columns
    out = calc.join(w, cond, "left")
    days = F.col("total_dias_uteis_semana")
    return out.select(
        *keep, "soma_peso_os_semana_aprovador", "total_os_semana_aprovador", "total_dias_uteis_semana",
        (F.col("total_os_semana_aprovador").cast("double") / days).alias("media_diaria_os_aprovador"),
        (F.col("soma_peso_os_semana_aprovador") / days).alias("produtividade_semana_aprovador"))


def weekly_summary(rows: DataFrame, week_col: str = "YearWeek",
                   approver_col: str = "_aprovador") -> DataFrame:
    """C18 at its own grain: one row per (week, approver) with fact rows,
    distinct orders, weight sum, working days and productivity.

    Same two-level aggregate as ``weekly_totals``.  An order has a single
    approval date, so distinct orders per day add up to distinct orders per
    week; no COUNT(DISTINCT) over the whole week is needed, and none at all on
    rows at the grain of the order (``_n_rows``: fact rows of each).
    """
    one = "_n_rows" in rows.columns
    n = F.col("_n_rows") if one else F.lit(1)
    workday = (F.col("WeekDayNumber") <= R.LAST_WEEKDAY) & is_approval_day("HolidayOrBridge")
    per_day = rows.groupBy(week_col, approver_col, "data_aprovacao").agg(
        F.sum(F.col("peso_os") * n if one else F.col("peso_os")).alias("_w_peso"),
        F.sum(n).alias("_w_rows"),
        (F.count if one else F.countDistinct)("OrderServiceCode").alias("_w_orders"),
        F.max(workday.cast("int")).alias("_w_workday"),
    )
    per_week = per_day.groupBy(week_col, approver_col).agg(
        F.sum("_w_rows").cast("long").alias("fact_rows"),
        F.sum("_w_orders").cast("long").alias("orders"),
        F.sum("_w_peso").alias("soma_peso_os"),
        F.sum(F.when((F.col("_w_workday") == 1) & F.col("data_aprovacao").isNotNull(), 1)
              .otherwise(0)).cast("long").alias("_w_days"),
    )
    days = F.when(F.col(approver_col).isNull() | F.col(week_col).isNull()
                  | (F.col("_w_days") == 0), F.lit(None).cast("long")).otherwise(F.col("_w_days"))
    return per_week.select(
        week_col, approver_col, "fact_rows", "orders", "soma_peso_os",
        days.alias("total_dias_uteis_semana"),
        (F.col("soma_peso_os") / days).alias("produtividade_semana_aprovador"))
