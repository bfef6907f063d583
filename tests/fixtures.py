"""Tiny hand-built domain tables (all names and values invented).

Cases (FIXTURES.md): approver 1 / 2 / 3 / decider-only wins, nobody internal,
automatic TRUE / NULL, holiday / bridge / plain day, Saturday with and
without roster, NULL approver name, winning approver with NULL timestamp,
0 / cancelled-only / 3 / 4 / 51 items, a protocol with two attendances,
family fallbacks, claim with preventive type, history in one minute,
public / special customers, change-log edge cases.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from ratify.operators.calendar import build_calendar
from ratify.sources import schemas as S
from ratify.sources.catalog import Tables

T0 = dt.datetime(2025, 3, 3, 9, 0)   # Monday


def ts(days=0, hours=0):
    return T0 + dt.timedelta(days=days, hours=hours)


USERS = [
    (1, "10", "ana", True), (2, "20", "bruno", True), (3, "30", "carla", True),
    (4, "40", "dario", False), (5, "50", None, True), (6, "60", "eva", None),
    (7, "70", "fabio", True),
]

# OrderServiceCode, ext, auto, budget, a1ts, a2ts, a3ts, disapproval, descr,
# status, vehicle, type, a1, a2, a3, decider, merchant
SERVICES = [
    (100, False, False, ts(0, 0), ts(0, 2), ts(1, 0), ts(2, 0), None, "x", 1, 1, 1, 1, 4, 4, 4, 1),
    (101, True, False, ts(0, 0), ts(0, 1), ts(0, 3), ts(1, 1), None, "x", 1, 2, 2, 4, 2, 3, 4, 1),
    (102, False, False, ts(0, 0), ts(0, 1), ts(0, 2), ts(2, 5), None, "Sinistro", 2, 3, 2, 4, 6, 3, 4, 2),
    (103, False, False, ts(0, 0), None, None, None, ts(1, 0), "x", 2, 1, 1, 4, 4, 4, 7, 1),
    (104, False, False, ts(0, 0), ts(0, 1), None, None, None, "x", 1, 1, 1, 4, 4, 4, 4, 1),
    (105, False, True, ts(0, 0), ts(0, 1), None, None, None, "x", 1, 1, 1, 1, 4, 4, 4, 1),
    (106, False, None, ts(0, 0), ts(0, 1), None, None, None, "x", 1, 1, 1, 1, 4, 4, 4, 1),
    (107, False, False, ts(0, 0), ts(5, 1), None, None, None, "x", 1, 1, 1, 1, 4, 4, 4, 1),  # Saturday
    (108, False, False, ts(0, 0), ts(5, 1), None, None, None, "x", 1, 1, 1, 2, 4, 4, 4, 1),  # Saturday, roster
    (109, False, False, ts(0, 0), ts(1, 1), None, None, None, "x", 1, 1, 1, 5, 4, 4, 4, 1),  # NULL name
    (110, False, False, ts(0, 0), None, ts(1, 1), None, None, "x", 1, 1, 1, 1, 2, 4, 4, 1),  # winner ts NULL
    (111, False, False, ts(0, 0), ts(2, 1), None, None, None, "x", 1, 4, 3, 3, 4, 4, 4, 3),  # holiday
    (112, False, False, ts(0, 0), ts(3, 1), None, None, None, "x", 1, 4, 3, 3, 4, 4, 4, 3),  # bridge
    (113, False, False, ts(0, 0), ts(0, 4), None, None, None, "x", 1, 5, 1, 7, 4, 4, 4, 1),
]

VEHICLES = [(1, 900, "Leve", None), (2, 901, "Nao Identificado", "Pesado"),
            (3, 902, None, None), (4, 903, "Trator Especial", None), (5, 904, "Caminhao", None)]
TYPES = [(1, "Corretiva"), (2, "Preventiva"), (3, "Preventiva Programada")]
STATUSES = [(1, "Aprovada"), (2, "Reprovada")]
PROTOCOLS = [(1, 101), (2, 113)]
ATTENDANCES = [(1,), (1,)]   # protocol 1 (order 101) has two attendances
LABORS = [(1, "SUBSTITUIR"), (2, "REPARAR")]
MERCHANTS = [(1, "Oficina"), (2, "Concessionaria"), (3, None)]
CUSTOMER_RULES = [(901, "public"), (900, "special")]


def _items():
    rows = []
    k = 1

    def add(order, quoted, labor=1, cancelled=False, unit=D("10.00"), qty=D("2"),
            refs=(None, None, None, D("12.00")), approved=D("9.00")):
        nonlocal k
        neg_c, neg, ref_c, ref = refs
        rows.append((k, order, labor, quoted, approved, ref, ref_c, neg, neg_c, unit, approved, qty,
                     ts(0, 5) if cancelled else None))
        k += 1

    for _ in range(3):
        add(100, D("1000.00"))
    for _ in range(4):
        add(101, D("500.00"))
    add(102, D("50.00"), cancelled=True)
    for i in range(51):
        add(104, D("10.00"))
    # price fallback levels on order 113
    add(113, D("1.00"), refs=(D("11.00"), D("1.00"), None, None))   # neg. customer adheres
    add(113, D("1.00"), refs=(None, D("9.00"), D("99.00"), None))   # negotiated: not adherent
    add(113, D("1.00"), refs=(None, None, D("10.00"), D("1.00")))   # ref customer = unit: adheres
    add(113, D("1.00"), refs=(None, None, None, None))              # no reference: excluded
    add(113, D("1.00"), unit=D("0.10"))                            # unit 0.1: excluded
    add(113, D("1.00"), qty=D("0.5"))                              # qty < 1: excluded
    add(113, D("1.00"), labor=2)                                   # labor not listed: excluded
    return rows


HISTORY = [
    (100, 11, dt.datetime(2025, 3, 1, 10, 0, 5)), (100, 11, dt.datetime(2025, 3, 1, 10, 0, 50)),
    (100, 14, dt.datetime(2025, 3, 1, 10, 1, 0)), (101, 12, dt.datetime(2025, 3, 1, 10, 0)),
    (102, 14, dt.datetime(2025, 3, 1, 9, 0)), (102, 14, dt.datetime(2025, 3, 1, 9, 5)),
    (102, 14, dt.datetime(2025, 3, 1, 9, 9)),
]

PARAM_LOG = [
    # client 901: 'bruno' (code 20) added Feb 20, removed Mar 4 10:00, re-added Mar 4 10:00 (tie)
    (901, 586, dt.datetime(2025, 2, 20, 8, 0), None, " 20 ; 30,20"),
    (901, 586, dt.datetime(2025, 3, 4, 10, 0), "20;30", "30"),
    (901, 586, dt.datetime(2025, 3, 4, 10, 0), "30", "30,20"),
    # another parameter is ignored
    (901, 587, dt.datetime(2025, 2, 1, 8, 0), "", "10"),
    # client 900: 'ana' (10) added twice (ADD -> ADD closes the first interval)
    (900, 586, dt.datetime(2025, 3, 1, 8, 0), "", "10"),
    (900, 586, dt.datetime(2025, 3, 3, 8, 0), "", "10;;"),
]


def calendar(spark):
    hol = spark.createDataFrame([(dt.date(2025, 3, 5), "Holiday"), (dt.date(2025, 3, 6), "Bridge")],
                                "holiday_date date, label string")
    return build_calendar(spark, dt.date(2025, 2, 1), dt.date(2025, 3, 31), hol)


def tables(spark) -> Tables:
    mk = spark.createDataFrame
    return Tables(
        services=mk(SERVICES, S.SERVICES), items=mk(_items(), S.ITEMS), users=mk(USERS, S.USERS),
        dates=calendar(spark), vehicles=mk(VEHICLES, S.VEHICLES), types=mk(TYPES, S.TYPES),
        statuses=mk(STATUSES, S.STATUSES), protocols=mk(PROTOCOLS, S.PROTOCOLS),
        attendances=mk(ATTENDANCES, S.ATTENDANCES), history=mk(HISTORY, S.HISTORY),
        param_log=mk(PARAM_LOG, S.PARAM_LOG), labors=mk(LABORS, S.LABORS),
        merchants=mk(MERCHANTS, S.MERCHANTS),
        roster=mk([("bruno",)], S.ROSTER),
        customer_rules=mk(CUSTOMER_RULES, "customer_id long, class string"),
    )


def counted(df, column: str):
    """``df`` and an accumulator of how often a row's ``column`` is computed."""
    from pyspark.sql import functions as F

    seen = df.sparkSession.sparkContext.accumulator(0)

    def look(value):
        seen.add(1)
        return value

    return df.withColumn(column, F.udf(look, df.schema[column].dataType).asNondeterministic()(column)), seen
