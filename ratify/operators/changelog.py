"""Membership intervals from a change log of delimited lists.

Each log row holds a client's old and new member list as text.  The lists
are parsed into sets; members in new-but-not-old are ADD events and members
in old-but-not-new are REMOVE events.  Every ADD opens an interval that ends
at the *next event of any type* for the same (client, member); with no next
event it stays open (9999-12-31).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratify.functions.dates import minute_text
from ratify.functions.lists import list_adds, list_removes, parse_list
from ratify.operators.sequence import month_bucket, next_in_group
from ratify.sources import rules as R

TS_COL = "ParameterLogOrgValueModificationTimestamp"


def membership_changes(param_log: DataFrame, parameter_id: int | None = R.PARTNER_PRICE_PARAMETER_ID,
                       strip_whitespace: bool = True) -> DataFrame:
    """(CodigoCliente, ts, old_set, new_set) for one parameter."""
    log = param_log
    if parameter_id is not None:
        log = log.filter(F.col("ParameterId") == parameter_id)
    ts = F.col(TS_COL)
    if isinstance(log.schema[TS_COL].dataType, T.StringType):
        ts = ts.cast("timestamp_ntz")          # text stamps are read as wall-clock time
    return log.select(
        F.col("ClientId").alias("CodigoCliente"),
        ts.alias("ts"),
        parse_list("OldValueDescription", strip_whitespace).alias("old_set"),
        parse_list("NewValueDescription", strip_whitespace).alias("new_set"),
    )


def membership_events(changes: DataFrame) -> DataFrame:
    """(CodigoCliente, approver, ts, event_type) — one row per ADD / REMOVE."""
    adds = changes.select("CodigoCliente", "ts",
                          F.explode(list_adds(F.col("old_set"), F.col("new_set"))).alias("approver"),
                          F.lit("ADD").alias("event_type"))
    removes = changes.select("CodigoCliente", "ts",
                             F.explode(list_removes(F.col("old_set"), F.col("new_set"))).alias("approver"),
                             F.lit("REMOVE").alias("event_type"))
    return adds.unionByName(removes).select(
        "CodigoCliente", F.col("approver").cast("string").alias("approver"), "ts", "event_type")


def membership_events_in_one_pass(changes: DataFrame) -> DataFrame:
    """``membership_events`` from one scan: both kinds come from one row, whose lists are parsed once."""
    old, new = F.col("old_set"), F.col("new_set")
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("event_type"), members.alias("members")) for kind, members in (
        ("ADD", list_adds(old, new)), ("REMOVE", list_removes(old, new)))]))
    return changes.select("CodigoCliente", "ts", kinds.alias("_kind")).select(
        "CodigoCliente", F.explode("_kind.members").alias("approver"), "ts",
        F.col("_kind.event_type").alias("event_type")).select(
        "CodigoCliente", F.col("approver").cast("string").alias("approver"), "ts", "event_type")


def order_events(events: DataFrame) -> DataFrame:
    """Add next_ts / next_event_type per (client, member), ordered by time.

    Ties on the timestamp are broken REMOVE before ADD, so the result does not
    depend on row order (rows equal on all four columns are interchangeable).
    A busy (client, member) history is split by month (see ``next_in_group``).
    """
    tie = F.when(F.col("event_type") == "ADD", 1).otherwise(0)
    ev = events.select("CodigoCliente", "approver", "event_type", "ts")
    return next_in_group(ev, ["CodigoCliente", "approver"], ["ts", tie], ["ts", "event_type"],
                         month_bucket("ts"))


def membership_intervals(param_log: DataFrame, users: DataFrame,
                         parameter_id: int | None = R.PARTNER_PRICE_PARAMETER_ID,
                         strip_whitespace: bool = True, members: DataFrame | None = None) -> DataFrame:
    """CodigoCliente, Aprovador, nome_aprovador, DataInicio, DataFim, DataInicioDate, DataFimDate.

    ``members`` (one column of codes, distinct): only the intervals of these; an interval ends at an event
    of its own member, so the events of others are dropped before they are put in order.
    """
    changes = membership_changes(param_log, parameter_id, strip_whitespace)
    if members is None:
        events = membership_events(changes)
    else:
        events = membership_events_in_one_pass(changes).join(members.toDF("_member"), F.col("approver") == F.col("_member"), "left_semi")
    return intervals_of(order_events(events), users)


def member_code() -> Column:
    """The text by which the log names a user."""
    return F.trim(F.col("WebUserSourceCode").cast("string"))


def intervals_of(ordered: DataFrame, users: DataFrame) -> DataFrame:
    """The interval that each ADD of the ordered events opens, with the member's user name."""
    adds = ordered.filter(F.col("event_type") == "ADD")
    # member codes are text in the log; compare as trimmed text on both sides
    u = users.select(member_code().alias("_code"),
                     F.col("WebUserName").alias("nome_aprovador"))
    joined = adds.join(u, adds["approver"] == u["_code"], "left")
    return joined.select(
        "CodigoCliente",
        F.col("approver").alias("Aprovador"),
        "nome_aprovador",
        minute_text("ts").alias("DataInicio"),
        minute_text("next_ts").alias("DataFim"),
        F.to_date("ts").alias("DataInicioDate"),
        F.coalesce(F.to_date("next_ts"), F.to_date(F.lit(R.OPEN_END))).alias("DataFimDate"),
    )
