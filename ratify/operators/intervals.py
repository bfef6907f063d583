"""Interval (range) join of approvals to membership intervals.

An approval matches an interval of the same client and approver name when
its date lies in [start, end] (inclusive).  A plain equi-join on (client,
approver) would compare every approval of a busy pair with every interval of
it; instead both sides also carry a time bucket (a year by default): an
interval is listed once per bucket it overlaps (clamped to the calendar span,
the only dates an approval can have), and an approval carries its own
bucket.  The equi-join is then on (client, approver, bucket) with the
inclusive range as a residual, so the pairs examined per key are the
intervals touching that bucket only (membership changes in one year, + 1).
The bucket grain trades interval expansion rows against candidates per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_index(d: Column, grain: str = "year") -> Column:
    if grain == "month":
        return F.year(d) * 12 + F.month(d) - 1
    return F.year(d)


def bucket_intervals(intervals: DataFrame, span: tuple[dt.date, dt.date] | None,
                     grain: str = "year") -> DataFrame:
    """One row per (interval, bucket overlapped inside ``span``)."""
    iv = intervals.select(
        F.col("CodigoCliente").alias("_iv_client"),
        F.col("nome_aprovador").alias("_iv_name"),
        F.col("DataInicioDate").alias("_iv_start"),
        F.col("DataFimDate").alias("_iv_end"),
    ).filter(F.col("_iv_name").isNotNull() & F.col("_iv_client").isNotNull())
    if span is None:
        return iv.withColumn("_iv_month", F.lit(0))
    lo, hi = F.lit(span[0]), F.lit(span[1])
    s = F.greatest(F.col("_iv_start"), lo)
    e = F.least(F.col("_iv_end"), hi)
    return (iv.filter(s <= e)
            .withColumn("_iv_month", F.explode(F.sequence(bucket_index(s, grain),
                                                           bucket_index(e, grain)))))


def _condition(base: DataFrame, iv: DataFrame, client: str, approver: str, date: str,
               span, grain: str = "year") -> Column:
    cond = ((base[client] == iv["_iv_client"]) & (base[approver] == iv["_iv_name"])
            & base[date].between(iv["_iv_start"], iv["_iv_end"]))
    if span is not None:
        cond = cond & (bucket_index(base[date], grain) == iv["_iv_month"])
    return cond


def interval_matches(keys: DataFrame, intervals: DataFrame, span: tuple[dt.date, dt.date] | None = None,
                     order: str = "OrderServiceCode", client: str = "CustomerId",
                     approver: str = "_aprovador", date: str = "data_aprovacao",
                     grain: str = "year") -> DataFrame:
    """_pm_order, _pm_matches: how many intervals hold the approval of each order that is in one.

    ``keys`` has the four key columns only, one row per order, so the range
    join shuffles narrow rows; the counts are partially aggregated per order.
    """
    iv = bucket_intervals(intervals, span, grain)
    hits = keys.join(iv, _condition(keys, iv, client, approver, date, span, grain), "inner")
    return hits.groupBy(F.col(order).alias("_pm_order")).agg(F.count(F.lit(1)).alias("_pm_matches"))


def attach_matches(rows: DataFrame, matches: DataFrame, mode: str = "faithful", order: str = "OrderServiceCode",
                   out: str = "preco_parceiro") -> DataFrame:
    """Add ``out`` (the order is in ``matches``) and ``_n_rows``: in mode 'faithful' how many rows the
    original's LEFT JOIN gives the order, in mode 'exists' 1."""
    if mode not in ("faithful", "exists"):
        raise ValueError(f"unknown price match mode {mode!r}")
    repeats = F.coalesce("_pm_matches", F.lit(1)) if mode == "faithful" else F.lit(1)
    return rows.join(matches, rows[order] == matches["_pm_order"], "left").select(
        *rows.columns, F.col("_pm_matches").isNotNull().alias(out), repeats.cast("long").alias("_n_rows"))


def interval_matches_by_key(keys: DataFrame, intervals: DataFrame, span: tuple[dt.date, dt.date] | None = None,
                            grain: str = "year") -> DataFrame:
    """As ``interval_matches`` where a code may repeat: _pm_matches for each distinct (order, customer, approver, day)."""
    names = {"OrderServiceCode": "_pm_order", "CustomerId": "_pm_client", "_aprovador": "_pm_name", "data_aprovacao": "_pm_day"}
    keys = keys.select(*[F.col(c).alias(n) for c, n in names.items()]).distinct()
    iv = bucket_intervals(intervals, span, grain)
    hits = keys.join(iv, _condition(keys, iv, "_pm_client", "_pm_name", "_pm_day", span, grain), "inner")
    return hits.groupBy(*names.values()).agg(F.count(F.lit(1)).alias("_pm_matches"))


def attach_matches_by_key(rows: DataFrame, matches: DataFrame, mode: str = "faithful",
                          out: str = "preco_parceiro") -> DataFrame:
    """As ``attach_matches`` with the matches of ``interval_matches_by_key``."""
    cond = (rows["OrderServiceCode"].eqNullSafe(matches["_pm_order"]) & (rows["CustomerId"] == matches["_pm_client"])
            & (rows["_aprovador"] == matches["_pm_name"]) & (rows["data_aprovacao"] == matches["_pm_day"]))
    repeats = F.coalesce("_pm_matches", F.lit(1)) if mode == "faithful" else F.lit(1)
    return rows.join(matches, cond, "left").select(
        *rows.columns, F.col("_pm_matches").isNotNull().alias(out), repeats.cast("long").alias("_n_rows"))


def partner_price_flag(base: DataFrame, intervals: DataFrame, mode: str = "faithful",
                       span: tuple[dt.date, dt.date] | None = None,
                       client: str = "CustomerId", approver: str = "_aprovador",
                       date: str = "data_aprovacao", out: str = "preco_parceiro",
                       grain: str = "year") -> DataFrame:
    """Add a boolean ``out``: the approval falls in a partner-price interval.

    mode 'faithful': left join — an approval matching k intervals yields k
    rows (as the original LEFT JOIN does).  mode 'exists': one row per
    approval, flag = at least one match (semi-join semantics).
    """
    iv = bucket_intervals(intervals, span, grain)
    if mode == "faithful":
        keep = base.columns
        joined = base.join(iv, _condition(base, iv, client, approver, date, span, grain), "left")
        return joined.select(*keep, F.col("_iv_client").isNotNull().alias(out))
    if mode != "exists":
        raise ValueError(f"unknown price match mode {mode!r}")
    keys = base.select(client, approver, date).distinct()
    hit = (keys.join(iv, _condition(keys, iv, client, approver, date, span, grain), "left_semi")
           .withColumn(out, F.lit(True)))
    return (base.join(hit, [client, approver, date], "left")
            .withColumn(out, F.coalesce(F.col(out), F.lit(False))))
