"""Approver attribution (C2), SLA window (C3) and the weekday/roster filter.

The winning approver is the first *internal* user among approver 1, 2, 3 and
then the decider (who disapproves).  Every derived column follows the same
priority chain, and a chain of ``when`` (not ``coalesce``) keeps a winning
branch whose timestamp is NULL as NULL instead of falling through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratify.functions.classify import is_true
from ratify.sources import rules as R

# (alias prefix, services column holding the user key)
ROLES = [("a1", "Sk_FirstApprover"), ("a2", "Sk_SecondApprover"),
         ("a3", "Sk_ThirdApprover"), ("dec", "Sk_ServiceOrderApprover")]


def attach_roles(services: DataFrame, users: DataFrame) -> DataFrame:
    """Join the user dimension once per role (N:1 left joins).

    The user directory is a dimension; Spark broadcasts it when its
    estimated size is under the broadcast threshold and shuffles otherwise.
    """
    # one projection joined under four aliases: the four broadcasts are the
    # same plan, so Spark builds the hash table once and reuses the exchange
    u = users.select("Sk_WebUser", "IsInternalUser", "WebUserName")
    out = services.alias("svc")
    keep = [F.col(f"svc.{c}") for c in services.columns]
    for tag, key in ROLES:
        out = out.join(u.alias(tag), F.col(f"svc.{key}") == F.col(f"{tag}.Sk_WebUser"), "left")
        keep += [F.col(f"{tag}.IsInternalUser").alias(f"{tag}_internal"),
                 F.col(f"{tag}.WebUserName").alias(f"{tag}_name")]
    return out.select(*keep)


def attach_merged_roles(services: DataFrame, users: DataFrame) -> DataFrame:
    """As ``attach_roles`` where user keys repeat, for callers that count rows: a row for each combination of
    flags and name of the user whose role wins (all four name columns hold it), and in ``_role_rows`` how many
    of the rows of ``attach_roles`` it stands for.  The names of losing roles tell no rows apart.
    """
    flags = users.groupBy("Sk_WebUser", "IsInternalUser").agg(F.count(F.lit(1)).alias("_n"))
    out = services.alias("svc")
    keep = [F.col(f"svc.{c}") for c in services.columns]
    for tag, key in ROLES:
        out = out.join(flags.alias(tag), F.col(f"svc.{key}") == F.col(f"{tag}.Sk_WebUser"), "left")
        keep += [F.col(f"{tag}.IsInternalUser").alias(f"{tag}_internal"), F.col(f"{tag}._n").alias(f"_{tag}_n")]
    out = out.select(*keep)
    wins = [is_true(f"{tag}_internal") for tag, _ in ROLES]
    out = out.withColumn("_winner", _chain([(won, F.col(key)) for won, (_, key) in zip(wins, ROLES)]))
    names = users.where(is_true("IsInternalUser")).groupBy(F.col("Sk_WebUser").alias("_name_key"), "WebUserName").agg(
        F.count(F.lit(1)).alias("_name_n"))
    out = out.join(names, F.col("_winner") == F.col("_name_key"), "left")
    # the winner's rows are counted by name, the others' by flag
    count = F.coalesce(F.col("_name_n"), F.lit(1))
    for i, (tag, _) in enumerate(ROLES):
        above = reduce(lambda a, b: a | b, wins[:i], F.lit(False))
        count = count * F.when(wins[i] & ~above, F.lit(1)).otherwise(F.coalesce(F.col(f"_{tag}_n"), F.lit(1)))
    return out.select(*services.columns, *[f"{tag}_internal" for tag, _ in ROLES],
                      *[F.col("WebUserName").alias(f"{tag}_name") for tag, _ in ROLES], count.alias("_role_rows"))


def _chain(pairs: list[tuple[Column, Column]]) -> Column:
    expr = None
    for cond, value in pairs:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def attribute_approver(df: DataFrame, sla_grain: str = "timestamp") -> DataFrame:
    """Add OS_Aprovada, _aprovador, data_aprovacao, _data_sla1/2 and any_internal.

    ``sla_grain='date'`` casts the SLA stage bounds to DATE (view variant).
    """
    i1, i2, i3, idec = (is_true(f"{t}_internal") for t, _ in ROLES)
    ts = {c: F.col(c) for c in ["FistBudgetSentTimestamp", "FirstApprovalTimestamp",
                                "SecondApprovalTimestamp", "ThirdApprovalTimestamp",
                                "DisapprovalTimestamp"]}
    sla1 = _chain([(i1, ts["FistBudgetSentTimestamp"]), (i2, ts["FirstApprovalTimestamp"]),
                   (i3, ts["SecondApprovalTimestamp"])])
    sla2 = _chain([(i1, ts["FirstApprovalTimestamp"]), (i2, ts["SecondApprovalTimestamp"]),
                   (i3, ts["ThirdApprovalTimestamp"])])
    if sla_grain == "date":
        sla1, sla2 = F.to_date(sla1), F.to_date(sla2)
    return df.withColumns({
        "OS_Aprovada": i1 | i2 | i3,
        "any_internal": i1 | i2 | i3 | idec,
        "_data_sla1": sla1,
        "_data_sla2": sla2,
        "data_aprovacao": _chain([
            (i1, F.to_date(ts["FirstApprovalTimestamp"])),
            (i2, F.to_date(ts["SecondApprovalTimestamp"])),
            (i3, F.to_date(ts["ThirdApprovalTimestamp"])),
            (idec, F.to_date(ts["DisapprovalTimestamp"])),
        ]),
        "_aprovador": _chain([(i1, F.col("a1_name")), (i2, F.col("a2_name")),
                              (i3, F.col("a3_name")), (idec, F.col("dec_name"))]),
    })


def weekday_filter(df: DataFrame, roster: DataFrame | None, policy: str = "roster",
                   approver_col: str = "_aprovador",
                   weekday_col: str = "WeekDayNumber") -> DataFrame:
    """Keep approvals on each approver's working days.

    policy 'roster': roster members Monday-Saturday, everyone else
    Monday-Friday; an approver with a NULL name is never kept (SQL IN/NOT IN
    are both unknown for NULL).  policy 'none': no weekday rule.
    """
    if policy == "none":
        return df
    if policy != "roster":
        raise ValueError(f"unknown weekday policy {policy!r}")
    if roster is None:
        flag = F.lit(False)
        out = df
    else:
        r = (roster.select(F.col("web_user_name").alias("_roster_name"))
             .filter(F.col("_roster_name").isNotNull()).distinct())
        out = df.join(r, df[approver_col] == r["_roster_name"], "left")
        flag = F.col("_roster_name").isNotNull()
    wd = F.col(weekday_col)
    keep = F.col(approver_col).isNotNull() & F.when(flag, wd <= R.LAST_WEEKDAY_ROSTER).otherwise(
        wd <= R.LAST_WEEKDAY)
    out = out.filter(keep)
    return out.drop("_roster_name") if roster is not None else out
