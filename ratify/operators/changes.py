"""Which orders a set of changed source rows can touch.

Every source reaches the fact by a key: some hold the order code, others reach
it over a dimension key, a client or a member list.  ``touched_orders`` joins
the changed keys of each source against the stored tables and unites the
results to one set of order codes; ``touched_months`` adds the days on which
those orders count now and counted before, and the months that the totals of
those days' weeks reach.

The joins are semi joins on narrow keys: the changed rows are the small side,
which Spark broadcasts if its size allows and shuffles otherwise.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.functions.lists import parse_list
from ratify.operators.attribution import ROLES, attach_roles, attribute_approver
from ratify.sources import rules as R
from ratify.sources.catalog import Tables

ORDER = "OrderServiceCode"
#: The columns of a changed row that tell what it touches.
CHANGE_KEYS = {
    "services": ["OrderServiceCode"], "items": ["MaintenanceId"], "history": ["cd_manutencao_oficina"],
    "protocols": ["ProtocolSourceCode"], "attendances": ["Sk_MaintenanceProtocol"],
    "statuses": ["Sk_ServiceOrderStatusType"], "vehicles": ["Sk_MaintenanceVehicle"], "types": ["Sk_MaintenanceType"],
    "merchants": ["Sk_MaintenanceMerchant"], "labors": ["Sk_MaintenanceLabor"],
    "users": ["Sk_WebUser", "WebUserSourceCode"], "param_log": ["ClientId", "ParameterId"],
    "dates": ["ReferenceDate"], "roster": ["web_user_name"], "customer_rules": ["customer_id"],
}
_OF_ORDER = {"services": "OrderServiceCode", "items": "MaintenanceId", "history": "cd_manutencao_oficina",
             "protocols": "ProtocolSourceCode"}
_OF_SERVICE = ("statuses", "vehicles", "types", "merchants")
STAGES = ["FistBudgetSentTimestamp", "FirstApprovalTimestamp", "SecondApprovalTimestamp", "ThirdApprovalTimestamp",
          "DisapprovalTimestamp"]


def _keys(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.select(F.col(column).alias(name or column)).where(F.col(name or column).isNotNull()).distinct()


def _orders_with(services: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    return services.join(keys, column, "left_semi").select(ORDER)


def _orders_of_clients(t: Tables, clients: DataFrame) -> DataFrame:
    """``clients``: CustomerId."""
    vehicles = t.vehicles.join(clients, "CustomerId", "left_semi")
    return _orders_with(t.services, _keys(vehicles, "Sk_MaintenanceVehicle"), "Sk_MaintenanceVehicle")


def _orders_of_users(t: Tables, users: DataFrame) -> DataFrame:
    """``users``: Sk_WebUser, in any of the four roles."""
    roles = t.services.select(ORDER, F.explode(F.array_distinct(F.array(*[F.col(c) for _, c in ROLES]))).alias("Sk_WebUser"))
    return _orders_with(roles, users, "Sk_WebUser")


def _clients_of_members(t: Tables, codes: DataFrame, parameter_id: int) -> DataFrame:
    """CustomerId of the clients whose lists ever held one of the member ``codes``."""
    log = t.param_log.where(F.col("ParameterId") == parameter_id)
    member = F.explode(F.array_union(parse_list("OldValueDescription"), parse_list("NewValueDescription")))
    listed = log.select(F.col("ClientId").alias("CustomerId"), member.alias("code"))
    return _keys(listed.join(codes, "code", "left_semi"), "CustomerId")


def _orders_over(t: Tables, days: DataFrame) -> list[DataFrame]:
    """Orders with a stage on or around a changed calendar day; days between two changed ones count as changed, too."""
    span = days.agg(F.min("ReferenceDate").alias("low"), F.max("ReferenceDate").alias("high")).first()
    if span["low"] is None:
        return []
    first, last = (f(*[F.to_date(c) for c in STAGES]) for f in (F.least, F.greatest))
    return [t.services.where((first <= F.lit(span["high"])) & (last >= F.lit(span["low"]))).select(ORDER)]


def touched_orders(changed: Mapping[str, DataFrame], t: Tables,
                   parameter_id: int = R.PARTNER_PRICE_PARAMETER_ID) -> DataFrame:
    """OrderServiceCode of every order that a changed row of some source can reach, once each.

    ``changed`` has, by source, rows with at least the columns of CHANGE_KEYS; ``t`` the tables as they are now.
    """
    unknown = set(changed) - set(CHANGE_KEYS)
    if unknown:
        raise ValueError(f"no rule for changes of {sorted(unknown)}")
    parts: list[DataFrame] = []
    for source, rows in changed.items():
        if source in _OF_ORDER:
            parts.append(rows.select(F.col(_OF_ORDER[source]).alias(ORDER)))
        elif source in _OF_SERVICE:
            key = CHANGE_KEYS[source][0]
            parts.append(_orders_with(t.services, _keys(rows, key), key))
        elif source == "attendances":
            protocols = t.protocols.join(_keys(rows, "Sk_MaintenanceProtocol"), "Sk_MaintenanceProtocol", "left_semi")
            parts.append(protocols.select(F.col("ProtocolSourceCode").alias(ORDER)))
        elif source == "labors":
            items = t.items.join(_keys(rows, "Sk_MaintenanceLabor"), "Sk_MaintenanceLabor", "left_semi")
            parts.append(items.select(F.col("MaintenanceId").alias(ORDER)))
        elif source == "param_log":
            own = rows.where(F.col("ParameterId") == parameter_id)
            parts.append(_orders_of_clients(t, _keys(own, "ClientId", "CustomerId")))
        elif source == "customer_rules":
            parts.append(_orders_of_clients(t, _keys(rows, "customer_id", "CustomerId")))
        elif source == "users":
            parts.append(_orders_of_users(t, _keys(rows, "Sk_WebUser")))
            codes = rows.select(F.trim(F.col("WebUserSourceCode").cast("string")).alias("code")).distinct()
            parts.append(_orders_of_clients(t, _clients_of_members(t, codes, parameter_id)))
        elif source == "roster":
            names = _keys(rows, "web_user_name", "WebUserName")
            parts.append(_orders_of_users(t, _keys(t.users.join(names, "WebUserName", "left_semi"), "Sk_WebUser")))
        else:
            parts += _orders_over(t, rows)
    if not parts:
        return t.services.select(ORDER).limit(0)
    return reduce(DataFrame.unionByName, parts).where(F.col(ORDER).isNotNull()).distinct()


def week_months(day: dt.date) -> set[int]:
    """The months (yyyymm) that the ISO week of a day reaches."""
    monday = day - dt.timedelta(days=day.weekday())
    return {d.year * 100 + d.month for d in (monday, monday + dt.timedelta(days=6))}


def month_range(month: int) -> tuple[dt.date, dt.date]:
    """First and last day of the whole weeks that a month (yyyymm) takes part in."""
    first = dt.date(month // 100, month % 100, 1)
    last = (first + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
    return first - dt.timedelta(days=first.weekday()), last + dt.timedelta(days=6 - last.weekday())


def month_ranges(months: set[int]) -> tuple[tuple[dt.date, dt.date], ...]:
    """The day ranges that the months need, joined where they meet."""
    out: list[tuple[dt.date, dt.date]] = []
    for low, high in map(month_range, sorted(months)):
        if out and low <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return tuple(out)


def touched_months(touched: DataFrame, t: Tables, held: DataFrame | None) -> set[int]:
    """Months whose rows or weekly totals can differ: those around each day on which a touched order
    counts by the tables ``t`` or counted in the stored fact ``held``."""
    now = attribute_approver(attach_roles(t.services.join(touched, ORDER, "left_semi"), t.users)).where(
        "any_internal").select("data_aprovacao")
    if held is not None:
        now = now.unionByName(held.join(touched, ORDER, "left_semi").select("data_aprovacao"))
    days = now.where("data_aprovacao IS NOT NULL").distinct().collect()  # at most one row a calendar day
    return set().union(*(week_months(r["data_aprovacao"]) for r in days))
