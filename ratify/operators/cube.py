"""Day cube under the reports (C22, C28): one row for each approver and approval day.

Week, month, portfolio and supervisor totals each rebuilt the fact.  The cube
is built from it once and kept as a versioned table by month; every coarser
grain then adds up a few rows a day.  An order has one approver and one
approval day, so counts of distinct orders add up over days and approvers, and
no bitmap of order codes has to be kept; approval days are counted from the
days themselves.  The hierarchy is joined when a report is made, so a change
of teams needs no new cube.

Measures: ``orders`` (distinct orders), ``fact_rows`` (rows of the fact, in
which an order can repeat) and ``soma_peso_os`` (weight over those rows).

Defined results: an approver without a name is a group of its own, as in the
fact; orders without weight count, and the sum is null if no row has one; an
empty fact gives an empty cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.operators.reports import month_of, sliced_names
from ratify.sources.versions import MONTH_COL, VersionedTable

MEASURES = ["orders", "fact_rows", "soma_peso_os"]


def day_cube(fact: DataFrame) -> DataFrame:
    """The cube of fact rows, or of rows at the grain of the order (with ``_n_rows``)."""
    keys = [F.col("data_aprovacao"), F.col("YearWeek").cast("long").alias("YearWeek"), F.col("_aprovador")]
    if "_n_rows" in fact.columns:
        days = fact.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("_n_rows").alias("fact_rows"),
            F.sum(F.col("peso_os") * F.col("_n_rows")).alias("soma_peso_os"))
    else:
        days = fact.groupBy(*keys, "OrderServiceCode").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("peso_os").alias("_weight")).groupBy(
            "data_aprovacao", "YearWeek", "_aprovador").agg(
            F.count(F.lit(1)).alias("orders"), F.sum("_rows").alias("fact_rows"), F.sum("_weight").alias("soma_peso_os"))
    # one type for both grains, so that a refreshed month fits the months that stay
    return days.withColumn("soma_peso_os", F.col("soma_peso_os").cast("decimal(38,6)")).withColumn(
        MONTH_COL, month_of("data_aprovacao").cast("int"))


def refresh_cube(table: VersionedTable, fact: DataFrame, months: set[int] | None = None) -> list[int]:
    """Rebuild the cube (all of it, or ``months``, yyyymm) as one commit; the months written.

    ``fact`` may hold other months, too: their parts stay as they are.
    """
    if months is None:
        return table.replace(day_cube(fact))
    wanted = month_of("data_aprovacao").isin(sorted(months))
    return table.rewrite(day_cube(fact.where(wanted)), months.__contains__)


def summary_from_cube(cube: DataFrame, hierarchy: DataFrame, grain: str = "month") -> DataFrame:
    """C22 from the cube: ``reports.approver_summary`` for grain 'week' or 'month'."""
    if grain not in ("week", "month"):
        raise ValueError(f"unknown grain {grain!r}")
    period = F.col("YearWeek") if grain == "week" else month_of("data_aprovacao")
    # a consultant listed twice reports to the first supervisor by name
    h = hierarchy.groupBy(F.col("consultant_name").alias("_h_name")).agg(F.min("supervisor_name").alias("supervisor_name"))
    rows = cube.withColumn("period", period).join(h, F.col("_aprovador") == F.col("_h_name"), "left")
    out = rows.rollup("period", "supervisor_name", "_aprovador").agg(
        F.sum("orders").alias("orders"), F.sum("soma_peso_os").alias("soma_peso_os"),
        F.countDistinct("data_aprovacao").alias("approval_days"), F.grouping_id().alias("level"))
    return out.withColumn("daily_avg_orders", F.col("orders").cast("double") / F.col("approval_days"))


def slice_totals(cube: DataFrame, hierarchy: DataFrame, start: str | None = None, end: str | None = None,
                 portfolio: str | None = None, supervisor: str | None = None) -> DataFrame:
    """C28 from the cube: totals by approver of the days in [start, end], for a portfolio and / or supervisor."""
    # the month is the partition, so months outside the range are not read
    for bound, day in ((">=", start), ("<=", end)):
        if day:
            month = int(day[:4]) * 100 + int(day[5:7])
            cube = cube.where(f"{MONTH_COL} {bound} {month} AND data_aprovacao {bound} DATE '{day}'")
    if portfolio or supervisor:
        names = sliced_names(hierarchy, portfolio, supervisor)
        cube = cube.join(names, cube["_aprovador"] == names["_v_name"], "left_semi")
    return cube.groupBy("_aprovador").agg(
        *[F.sum(m).alias(m) for m in MEASURES], F.countDistinct("data_aprovacao").alias("approval_days"))
