"""Domain tables derived from the driver's TPC-H-style tables.

The test tables are not service orders, so each domain source is *derived*
from them by Spark (every derived table is a projection of a driver table,
so its size grows with the driver data):

    services    <- orders     order = service order; roles and timestamps from keys
    items       <- lineitem   line = item; 'R' lines are cancelled
    users       <- nation     25 approvers; region decides internal / external / unknown
    vehicles    <- customer   market segment -> vehicle family
    protocols   <- orders     (2-HIGH, F) orders open one protocol
    attendances <- lineitem   accepted ('A') open ('O') lines attend the order's protocol
    history     <- events     click = review (11), view = quote (14)
    param_log   <- orders     each order logs its approver list for its customer
    merchants   <- supplier   negative balance = dealership
    calendar    <- orders     date range of the orders (see ``analog_calendar``)

The dimension lists that have no driver counterpart (maintenance types,
statuses, labors) are small literal tables here.  The same derivation is
written independently in SQL for the oracle (``ratify.plans.oracle``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratify.sources.catalog import Tables
from ratify.sources.rules import literal_table
from ratify.operators.calendar import build_calendar, recurring_holidays

# Analog parameters (ours).
ANALOG_START_DATE = "1996-01-01"
ANALOG_THRESHOLD_SCALE = 20
CALENDAR_TAIL_DAYS = 14
# Recurring holidays (month-day, label) used for the analog calendar.
ANALOG_HOLIDAYS = [
    ("01-01", "Holiday"), ("04-21", "Holiday"), ("05-01", "Holiday"), ("09-07", "Holiday"),
    ("10-12", "Holiday"), ("11-02", "Holiday"), ("11-15", "Holiday"), ("12-25", "Holiday"),
    ("12-24", "Bridge"), ("12-31", "Bridge"),
]
MAINTENANCE_TYPES = [(1, "Corretiva"), (2, "Preventiva"), (3, "Preventiva Programada"),
                     (4, "Corretiva"), (5, None)]
STATUSES = [(1, "Finalizada"), (2, "Em Aberto"), (3, "Parcial")]
LABORS = [(0, "SUBSTITUIR"), (1, "SUBSTITUIR COM REVISAO CUBO"),
          (2, "SUBSTITUIR SEM REVISAO CUBO"), (3, "FORNECIMENTO DE PECAS"),
          (4, "REPARAR"), (5, "MAO DE OBRA")]


def read_driver(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _hours(ts, n):
    return F.timestamp_add("HOUR", n, ts)


def _mod(c, n):
    return F.pmod(c, F.lit(n))


def _money(c):
    return F.col(c).cast("decimal(18,2)")


def analog_services(orders: DataFrame) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    # driver timestamps are timestamp_ntz (wall clock): arithmetic on them does not
    # depend on the session time zone
    day = F.col("o_orderdate")
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return orders.select(
        k.alias("OrderServiceCode"),
        (status == "O").alias("IsExternalApproval"),
        F.when(price < 20000, True).when((price < 40000) & (status == "P"), F.lit(None))
         .otherwise(False).cast("boolean").alias("IsAutomaticApproval"),
        _hours(day, _mod(k, 10)).alias("FistBudgetSentTimestamp"),
        _hours(day, 10 + _mod(k, 30)).alias("FirstApprovalTimestamp"),
        F.when(_mod(k, 11) == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_hours(day, 40 + _mod(k, 40))).alias("SecondApprovalTimestamp"),
        _hours(day, 80 + _mod(k, 50)).alias("ThirdApprovalTimestamp"),
        _hours(day, 5 + _mod(k, 20)).alias("DisapprovalTimestamp"),
        F.when((F.col("o_orderpriority") == "1-URGENT") & (status == "F"), F.lit("Sinistro"))
         .otherwise(F.col("o_orderpriority")).alias("MaintenanceTypeDescription"),
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).cast("long")
         .alias("Sk_ServiceOrderStatusType"),
        cust.alias("Sk_MaintenanceVehicle"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("Sk_MaintenanceType"),
        F.when(_mod(k, 7) == 0, F.lit(None).cast("long")).otherwise(_mod(cust, 25))
         .alias("Sk_FirstApprover"),
        _mod(k, 25).alias("Sk_SecondApprover"),
        _mod(F.floor(k / 25), 25).cast("long").alias("Sk_ThirdApprover"),
        _mod(cust + k, 25).alias("Sk_ServiceOrderApprover"),
        _mod(k, 10).alias("Sk_MaintenanceMerchant"),
    )


def analog_items(lineitem: DataFrame) -> DataFrame:
    quoted = _money("l_extendedprice")
    # money stays within 18 digits so Spark keeps it as a compact (long-backed) decimal
    approved = (quoted * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")

    def ref(cond, factor):
        return F.when(cond, (quoted * F.lit(Decimal(factor))).cast("decimal(18,4)"))

    return lineitem.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("Sk_MaintenanceItem"),
        F.col("l_orderkey").alias("MaintenanceId"),
        _mod(F.col("l_partkey"), 6).alias("Sk_MaintenanceLabor"),
        quoted.alias("QuotedPrice"),
        approved.alias("PriceApproved"),
        ref(F.col("l_quantity") > 10, "0.97").alias("PartReferencePrice"),
        ref(F.col("l_discount") >= 0.05, "1.02").alias("PartPriceReferenceCustomer"),
        ref(F.col("l_tax") >= 0.05, "0.98").alias("PartPriceNegociated"),
        ref((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"), "1.05")
        .alias("PartPriceNegociatedCustomer"),
        quoted.alias("PartUnitaryPrice"),
        approved.alias("PartPriceApproved"),
        (F.col("l_quantity").cast("decimal(18,3)") - 1).alias("PartQuantity"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))
         .alias("CancellationTimestamp"),
    )


def analog_users(nation: DataFrame) -> DataFrame:
    region = F.col("n_regionkey")
    return nation.select(
        F.col("n_nationkey").cast("long").alias("Sk_WebUser"),
        F.col("n_nationkey").cast("string").alias("WebUserSourceCode"),
        F.when(F.col("n_nationkey") == 12, F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("WebUserName"),
        F.when(region == 4, F.lit(None).cast("boolean"))
         .otherwise(region.isin(0, 1, 2)).alias("IsInternalUser"),
    )


def analog_vehicles(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    family = (F.when(seg == "AUTOMOBILE", "Leve").when(seg == "BUILDING", "Caminhao")
              .when(seg == "MACHINERY", "Nao Identificado")
              .when(seg == "HOUSEHOLD",
                    F.when(F.col("c_acctbal") < 0, "Trator Especial").otherwise("Pickup Media")))
    nat3 = _mod(F.col("c_nationkey"), 3)
    category = F.when(nat3 == 0, "Pesado").when(nat3 == 1, "Nao Identificado")
    return customer.select(
        F.col("c_custkey").alias("Sk_MaintenanceVehicle"),
        F.col("c_custkey").alias("CustomerId"),
        family.alias("maintenancemodelfamily"),
        category.alias("familycategory"),
    )


def analog_customer_rules(customer: DataFrame) -> DataFrame:
    seg, bal = F.col("c_mktsegment"), F.col("c_acctbal")
    cls = (F.when((seg == "FURNITURE") & (bal > 5000), "public")
           .when((seg == "HOUSEHOLD") & (bal > 8000), "special"))
    return (customer.select(F.col("c_custkey").alias("customer_id"), cls.alias("class"))
            .filter(F.col("class").isNotNull()))


def analog_protocols(orders: DataFrame) -> DataFrame:
    return (orders.filter((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "F"))
            .select(F.col("o_orderkey").alias("Sk_MaintenanceProtocol"),
                    F.col("o_orderkey").alias("ProtocolSourceCode")))


def analog_attendances(lineitem: DataFrame) -> DataFrame:
    return (lineitem.filter((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"))
            .select(F.col("l_orderkey").alias("Sk_MaintenanceProtocol")))


def analog_history(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    code = (F.when(et == "click", 11).when(et == "view", 14).when(et == "purchase", 12)
            .otherwise(0))
    return events.select(
        (F.col("user_id") * 31 + F.dayofmonth("ts")).alias("cd_manutencao_oficina"),
        code.cast("int").alias("cd_evento_manutencao_oficina"),
        F.col("ts").alias("dt_modificacao"),
    )


def analog_param_log(orders: DataFrame) -> DataFrame:
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    a1 = F.when(_mod(k, 7) == 0, F.lit(None).cast("long")).otherwise(_mod(cust, 25))
    a2, a3 = _mod(k, 25), _mod(F.floor(k / 25), 25)
    dec = _mod(cust + k, 25)
    new = F.concat(F.coalesce(a1.cast("string"), F.lit("")), F.lit(" ;"), a2.cast("string"),
                   F.lit(", "), a3.cast("string"))
    old = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string")).otherwise(
        F.concat(dec.cast("string"), F.lit(","), a2.cast("string"), F.lit(";;")))
    return orders.select(
        cust.alias("ClientId"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), 586)
         .otherwise(590).cast("int").alias("ParameterId"),
        _hours(F.col("o_orderdate"), _mod(k, 8))
         .alias("ParameterLogOrgValueModificationTimestamp"),
        old.alias("OldValueDescription"),
        new.alias("NewValueDescription"),
    )


def analog_merchants(supplier: DataFrame) -> DataFrame:
    mtype = (F.when(F.col("s_acctbal") < 0, "Concessionaria")
             .when(_mod(F.col("s_nationkey"), 4) == 0, F.lit(None)).otherwise("Oficina"))
    return supplier.select(F.col("s_suppkey").alias("Sk_MaintenanceMerchant"),
                           mtype.alias("NameMerchantsTypes"))


def analog_roster(users: DataFrame, nation: DataFrame) -> DataFrame:
    """Saturday roster: approvers of region 1."""
    return (nation.filter(F.col("n_regionkey") == 1)
            .select(F.col("n_name").alias("web_user_name")))


def analog_assignments(nation: DataFrame) -> DataFrame:
    """Calendar classes by person: region 1 works Saturdays up to mid-1997 and late hours from 1998 on, with the
    default between; region 2 works Saturdays from a Wednesday in July 1996 on."""
    day = lambda text: F.lit(text).cast("date")
    spans = {1: [(None, "1997-06-30", "saturdays"), ("1998-01-01", None, "late")], 2: [("1996-07-03", None, "saturdays")]}
    listed = lambda rows: F.array(*[F.struct(day(a).alias("valid_from"), day(b).alias("valid_to"),
                                             F.lit(c).alias("calendar_class")) for a, b, c in rows])
    return (nation.where(F.col("n_regionkey").isin(*spans) & (F.col("n_nationkey") != 12))
            .select(F.col("n_name").alias("web_user_name"),
                    F.explode(F.when(F.col("n_regionkey") == 1, listed(spans[1])).otherwise(listed(spans[2]))).alias("a"))
            .select("web_user_name", "a.*"))


def analog_hierarchy(nation: DataFrame, region: DataFrame) -> DataFrame:
    j = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner")
    name = F.when(F.col("n_nationkey") == 12, F.lit(None).cast("string")).otherwise(F.col("n_name"))
    return j.select(
        F.concat(F.lower(F.col("n_name")), F.lit("@ops.example")).alias("consultant_email"),
        name.alias("consultant_name"),
        F.concat(F.lower(F.col("r_name")), F.lit("@ops.example")).alias("supervisor_email"),
        F.col("r_name").alias("supervisor_name"),
        F.col("r_name").alias("portfolio"),
    )


def analog_reporting(nation: DataFrame, region: DataFrame) -> DataFrame:
    """The hierarchy with the supervisors as rows of their own: region 4 reports to 2, 2 to 1 and 1 to 4
    (a circle), 3 reports to 0 and 0 to nobody."""
    above = F.expr("CASE r_regionkey WHEN 4 THEN 2 WHEN 2 THEN 1 WHEN 1 THEN 4 WHEN 3 THEN 0 END")
    email = F.concat(F.lower(F.col("r_name")), F.lit("@ops.example"))
    leads = region.select(F.col("r_name").alias("consultant_name"), email.alias("consultant_email"), above.alias("_above"))
    heads = region.select(F.col("r_regionkey").alias("_above"), F.col("r_name").alias("supervisor_name"),
                          email.alias("supervisor_email"), F.col("r_name").alias("portfolio"))
    return analog_hierarchy(nation, region).unionByName(leads.join(heads, "_above", "left").drop("_above"))


def analog_supervision(supplier: DataFrame) -> DataFrame:
    """A hierarchy that grows with its table: person k reports to k // 4; 1, 2 and 3 report to each other in a circle."""
    person = F.col("s_suppkey").cast("long")
    above = F.when(person < 4, person % 3 + 1).otherwise(F.floor(person / 4))
    email = lambda k: F.concat(F.lit("s"), k.cast("string"), F.lit("@ops.example"))
    return supplier.select(email(person).alias("consultant_email"), F.col("s_name").alias("consultant_name"),
                           email(above).alias("supervisor_email"), F.lit(None).cast("string").alias("supervisor_name"),
                           F.lit(None).cast("string").alias("portfolio"))


def analog_duplicates(t: Tables) -> Tables:
    """The tables with repeated keys: exact repeats, and second rows that differ in a grouped or an ungrouped column."""
    def more(df: DataFrame, *extra: tuple) -> DataFrame:
        out = df
        for condition, changed in extra:
            out = out.unionByName(df.where(condition).withColumns(changed))
        return out

    order, user, vehicle = F.col("OrderServiceCode"), F.col("Sk_WebUser"), F.col("Sk_MaintenanceVehicle")
    return dataclasses.replace(
        t,
        services=more(t.services, (order % 16 == 5, {}), (order % 16 == 9, {"IsExternalApproval": ~F.col("IsExternalApproval")}),
                      (order % 16 == 11, {"Sk_MaintenanceMerchant": (F.col("Sk_MaintenanceMerchant") + 1) % 10})),
        users=more(t.users, (user % 6 == 1, {}), (user % 8 == 3, {"WebUserName": F.concat("WebUserName", F.lit(" II"))}),
                   (user % 9 == 4, {"IsInternalUser": F.lit(None).cast("boolean")})),
        vehicles=more(t.vehicles, (vehicle % 10 == 3, {}), (vehicle % 10 == 7, {"maintenancemodelfamily": F.lit("Leve")})),
        types=more(t.types, (F.col("Sk_MaintenanceType") == 2, {"MaintenanceType": F.lit("Preventiva Programada")}),
                   (F.col("Sk_MaintenanceType") == 4, {})),
        statuses=more(t.statuses, (F.col("Sk_ServiceOrderStatusType") == 2, {})),
        labors=more(t.labors, (F.col("Sk_MaintenanceLabor") == 1, {})),
        merchants=more(t.merchants, (F.col("Sk_MaintenanceMerchant") % 3 == 0, {})))


def analog_audit(lineitem: DataFrame) -> DataFrame:
    return (lineitem.filter(F.col("l_returnflag") == "R")
            .select(F.col("l_orderkey").alias("OrderServiceCode"),
                    _money("l_extendedprice").alias("disallowed_amount")))


def analog_sla_target(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    hours = (F.when(seg == "AUTOMOBILE", 24).when(seg == "BUILDING", 48)
             .when(seg == "MACHINERY", 36).otherwise(72))
    return customer.select(F.col("c_custkey").alias("customer_id"),
                           hours.cast("decimal(9,2)").alias("target_hours"))


def analog_sheets(t: Tables) -> dict[str, DataFrame]:
    """Sheets as text, as people fill them in, with faults planted by key."""
    line, customer = t.extra["lineitem"], t.extra["customer"]
    order = F.col("l_orderkey")
    code = F.when(order % 50 == 7, F.concat(F.lit("#"), order)).when(order % 50 == 9, (-order).cast("string")).otherwise(
        order.cast("string"))
    audit = line.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 2)).select(
        code.alias("OrderServiceCode"), F.when(F.col("l_linenumber") == 2, F.lit("")).otherwise(
            (F.col("l_extendedprice").cast("decimal(18,2)") - 5000).cast("string")).alias("disallowed_amount"))
    key = F.col("c_custkey")
    target = customer.select(key.cast("string").alias("customer_id"), (key % 20).cast("string").alias("target_hours"))
    target = target.unionAll(customer.where(key % 30 == 4).select(key.cast("string"), F.lit("8 hours")))
    rules = customer.select(key.alias("customer_id"), F.when(key % 9 == 1, "private").when(key % 2 == 0, "public")
                            .otherwise("special").alias("class"))
    rules = rules.unionAll(customer.where(key % 25 == 6).select(key, F.lit("public")))
    roster = t.roster.select(F.upper("web_user_name").alias("web_user_name")).unionAll(
        t.roster.select(F.concat("web_user_name", F.lit(" X"))))
    return {"audit": audit, "sla_target": target, "customer_rules": rules, "roster": roster}


def order_date_range(orders: DataFrame) -> tuple[dt.date, dt.date]:
    """(first order date, last order date + tail).

    MIN/MAX of a bare column are answered from Parquet footer statistics
    (aggregate push-down), so this reads no data pages.
    """
    row = orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    lo = lo.date() if isinstance(lo, dt.datetime) else lo
    hi = hi.date() if isinstance(hi, dt.datetime) else hi
    return lo, hi + dt.timedelta(days=CALENDAR_TAIL_DAYS)


def analog_calendar(spark: SparkSession, orders: DataFrame) -> DataFrame:
    lo, hi = order_date_range(orders)
    hol = recurring_holidays(spark, lo.year, hi.year, ANALOG_HOLIDAYS)
    return build_calendar(spark, lo, hi, hol)


# Derived-table *plans* per (session, folder): building them reads Parquet
# footers and creates many expressions, so queries in one session share them.
# Nothing is cached as data; every query still scans the tables.
_PLAN_CACHE: dict = {}


def analog_tables(spark: SparkSession, sf_dir: str, with_calendar: bool = True) -> Tables:
    """All domain sources derived from the driver tables under ``sf_dir``."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, with_calendar)
    hit = _PLAN_CACHE.get(key)
    if hit is None:
        hit = _PLAN_CACHE[key] = _analog_tables(spark, sf_dir, with_calendar)
    return hit


def _analog_tables(spark: SparkSession, sf_dir: str, with_calendar: bool) -> Tables:
    orders = read_driver(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                         "o_totalprice", "o_orderdate", "o_orderpriority")
    lineitem = read_driver(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                           "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                           "l_returnflag", "l_linestatus", "l_shipdate")
    nation = read_driver(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_driver(spark, sf_dir, "region", "r_regionkey", "r_name")
    customer = read_driver(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal",
                           "c_mktsegment")
    supplier = read_driver(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    events = read_driver(spark, sf_dir, "events", "ts", "user_id", "event_type")
    users = analog_users(nation)
    dates = analog_calendar(spark, orders) if with_calendar else None
    return Tables(
        services=analog_services(orders),
        items=analog_items(lineitem),
        users=users,
        dates=dates,
        vehicles=analog_vehicles(customer),
        types=literal_table(spark, MAINTENANCE_TYPES, "Sk_MaintenanceType long, MaintenanceType string"),
        statuses=literal_table(spark, STATUSES, "Sk_ServiceOrderStatusType long, StatusTypeDescription string"),
        protocols=analog_protocols(orders),
        attendances=analog_attendances(lineitem),
        history=analog_history(events),
        param_log=analog_param_log(orders),
        labors=literal_table(spark, LABORS, "Sk_MaintenanceLabor long, LaborName string"),
        merchants=analog_merchants(supplier),
        roster=analog_roster(users, nation),
        customer_rules=analog_customer_rules(customer),
        hierarchy=analog_hierarchy(nation, region),
        audit=analog_audit(lineitem),
        sla_target=analog_sla_target(customer),
        extra={"orders": orders, "lineitem": lineitem, "customer": customer, "nation": nation,
               "region": region, "events": events, "supplier": supplier},
    )
