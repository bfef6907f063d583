"""Schemas of the source tables the pipeline reads (column contract).

Source column names keep the spelling of the upstream warehouse, including
``FistBudgetSentTimestamp`` and ``PartPriceNegociated*``.  Only the columns the
pipeline reads are listed; readers select exactly these, so a columnar scan
never reads more.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S, B, TS, D = (T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(),
                     T.TimestampType(), T.DateType())
MONEY = T.DecimalType(18, 2)
QTY = T.DecimalType(18, 3)


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SERVICES = _schema(
    ("OrderServiceCode", L), ("IsExternalApproval", B), ("IsAutomaticApproval", B),
    ("FistBudgetSentTimestamp", TS), ("FirstApprovalTimestamp", TS),
    ("SecondApprovalTimestamp", TS), ("ThirdApprovalTimestamp", TS),
    ("DisapprovalTimestamp", TS), ("MaintenanceTypeDescription", S),
    ("Sk_ServiceOrderStatusType", L), ("Sk_MaintenanceVehicle", L), ("Sk_MaintenanceType", L),
    ("Sk_FirstApprover", L), ("Sk_SecondApprover", L), ("Sk_ThirdApprover", L),
    ("Sk_ServiceOrderApprover", L), ("Sk_MaintenanceMerchant", L),
)

ITEMS = _schema(
    ("Sk_MaintenanceItem", L), ("MaintenanceId", L), ("Sk_MaintenanceLabor", L),
    ("QuotedPrice", MONEY), ("PriceApproved", MONEY), ("PartReferencePrice", MONEY),
    ("PartPriceReferenceCustomer", MONEY), ("PartPriceNegociated", MONEY),
    ("PartPriceNegociatedCustomer", MONEY), ("PartUnitaryPrice", MONEY),
    ("PartPriceApproved", MONEY), ("PartQuantity", QTY), ("CancellationTimestamp", TS),
)

USERS = _schema(("Sk_WebUser", L), ("WebUserSourceCode", S), ("WebUserName", S),
                ("IsInternalUser", B))

DATES = _schema(("ReferenceDate", D), ("YearWeek", I), ("WeekDayNumber", I),
                ("HolidayOrBridge", S))

VEHICLES = _schema(("Sk_MaintenanceVehicle", L), ("CustomerId", L),
                   ("maintenancemodelfamily", S), ("familycategory", S))

TYPES = _schema(("Sk_MaintenanceType", L), ("MaintenanceType", S))

STATUSES = _schema(("Sk_ServiceOrderStatusType", L), ("StatusTypeDescription", S))

PROTOCOLS = _schema(("Sk_MaintenanceProtocol", L), ("ProtocolSourceCode", L))

ATTENDANCES = _schema(("Sk_MaintenanceProtocol", L))

HISTORY = _schema(("cd_manutencao_oficina", L), ("cd_evento_manutencao_oficina", I),
                  ("dt_modificacao", TS))

PARAM_LOG = _schema(("ClientId", L), ("ParameterId", I),
                    ("ParameterLogOrgValueModificationTimestamp", TS),
                    ("OldValueDescription", S), ("NewValueDescription", S))

LABORS = _schema(("Sk_MaintenanceLabor", L), ("LaborName", S))

MERCHANTS = _schema(("Sk_MaintenanceMerchant", L), ("NameMerchantsTypes", S))

# Parameter sheets (our governed replacements for spreadsheets).
ROSTER = _schema(("web_user_name", S))
HIERARCHY = _schema(("consultant_email", S), ("consultant_name", S),
                    ("supervisor_email", S), ("supervisor_name", S), ("portfolio", S))
AUDIT = _schema(("OrderServiceCode", L), ("disallowed_amount", MONEY))
SLA_TARGET = _schema(("customer_id", L), ("target_hours", T.DecimalType(9, 2)))
HOLIDAYS = _schema(("holiday_date", D), ("label", S))
CUSTOMER_RULES = _schema(("customer_id", L), ("class", S))
THRESHOLDS = _schema(("family", S), ("lo", MONEY), ("hi", MONEY))
FACTORS = _schema(("severity", S), ("factor", T.DecimalType(2, 1)))
MINUTES = _schema(("kind", S), ("band", S), ("minutes", I))
LABOR_WHITELIST = _schema(("labor_name", S))

SOURCE_SCHEMAS = {
    "services": SERVICES, "items": ITEMS, "users": USERS, "dates": DATES,
    "vehicles": VEHICLES, "types": TYPES, "statuses": STATUSES, "protocols": PROTOCOLS,
    "attendances": ATTENDANCES, "history": HISTORY, "param_log": PARAM_LOG,
    "labors": LABORS, "merchants": MERCHANTS,
}

PARAMETER_SCHEMAS = {
    "roster": (ROSTER, ["web_user_name"]),
    "hierarchy": (HIERARCHY, ["consultant_email"]),
    "audit": (AUDIT, None),
    "sla_target": (SLA_TARGET, ["customer_id"]),
    "holidays": (HOLIDAYS, ["holiday_date"]),
}
