"""Governed sheets and dimensions (S5): contracts checked in the job that reads them.

A contract names the columns with their types, the key, columns that must be
there, domains, ranges, bounds in order and references to other tables.
``govern`` reads a sheet once, writes it with the faults of each row, rows
without faults apart from the others, and counts rows and faults by ``observe``
in that same job.  So a bad sheet costs no second scan, the rows that were
refused stay to be looked at, and the caller decides whether any are too many.

Faults, as text: ``type:c`` (does not read as the type of c), ``missing:c``,
``domain:c``, ``range:c``, ``order:a<=b``, ``refers:c`` (the key is not in the
other table) and ``key`` (the key stands more than once; all its rows are set
aside, since none is known to be the right one).  A value that does not read
counts as missing for the other rules, and nulls fail no rule but ``missing``.
A lacking column fails at once.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratify.sources import rules as R
from ratify.sources import schemas as S


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()                                    # beside the key
    domains: Mapping[str, tuple] = field(default_factory=dict)
    ranges: Mapping[str, tuple] = field(default_factory=dict)         # column -> (least, most); None = open
    ordered: tuple[tuple[str, str], ...] = ()                         # (low, high) columns
    refers: Mapping[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, its column)

    def faults(self, tables: Mapping[str, DataFrame]) -> list[str]:
        """Every fault that a row can have, given the tables at hand."""
        names = [f"type:{f.name}" for f in self.schema.fields] + [f"missing:{c}" for c in (*self.key, *self.required)]
        names += [f"domain:{c}" for c in self.domains] + [f"range:{c}" for c in self.ranges]
        names += [f"order:{a}<={b}" for a, b in self.ordered]
        names += [f"refers:{c}" for c, (table, _) in self.refers.items() if table in tables]
        return names + (["key"] if self.key else [])


KINDS = tuple(R.STANDARD_MINUTES)
BANDS = tuple(label for _, label in R.ITEM_BANDS)
SEVERITIES = tuple(label for label, _ in R.SEVERITY_FACTORS)

#: The ten kinds of sheets.
SHEETS = {
    "roster": Contract(S.ROSTER, key=("web_user_name",), refers={"web_user_name": ("users", "WebUserName")}),
    "hierarchy": Contract(S.HIERARCHY, key=("consultant_email",), required=("supervisor_email",),
                          refers={"consultant_name": ("users", "WebUserName")}),
    "audit": Contract(S.AUDIT, required=("OrderServiceCode", "disallowed_amount"), ranges={"disallowed_amount": (0, None)},
                      refers={"OrderServiceCode": ("services", "OrderServiceCode")}),
    "sla_target": Contract(S.SLA_TARGET, key=("customer_id",), required=("target_hours",),
                           ranges={"target_hours": (Decimal("0.01"), None)}, refers={"customer_id": ("vehicles", "CustomerId")}),
    "holidays": Contract(S.HOLIDAYS, key=("holiday_date",), required=("label",), domains={"label": ("Holiday", R.BRIDGE_LABEL)}),
    "customer_rules": Contract(S.CUSTOMER_RULES, key=("customer_id", "class"),
                               domains={"class": ("public", "special")}, refers={"customer_id": ("vehicles", "CustomerId")}),
    "thresholds": Contract(S.THRESHOLDS, key=("family",),
                           required=("lo", "hi"), ranges={"lo": (0, None)}, ordered=(("lo", "hi"),)),
    "factors": Contract(S.FACTORS, key=("severity",), required=("factor",),
                        domains={"severity": SEVERITIES}, ranges={"factor": (Decimal("0.1"), None)}),
    "minutes": Contract(S.MINUTES, key=("kind", "band"),
                        required=("minutes",), domains={"kind": KINDS, "band": BANDS}, ranges={"minutes": (1, 24 * 60)}),
    "labor_whitelist": Contract(S.LABOR_WHITELIST, key=("labor_name",),
                                refers={"labor_name": ("labors", "LaborName")}),
}

#: The dimensions whose keys the fact takes as unique (``FactOptions(duplicates="merge")`` does not).
DIMENSIONS = {
    "users": Contract(S.USERS, key=("Sk_WebUser",)),
    "dates": Contract(S.DATES, key=("ReferenceDate",), required=("YearWeek", "WeekDayNumber"), ranges={"WeekDayNumber": (0, 6)}),
    "vehicles": Contract(S.VEHICLES, key=("Sk_MaintenanceVehicle",)),
    "types": Contract(S.TYPES, key=("Sk_MaintenanceType",)),
    "statuses": Contract(S.STATUSES, key=("Sk_ServiceOrderStatusType",)),
    "labors": Contract(S.LABORS, key=("Sk_MaintenanceLabor",)),
    "merchants": Contract(S.MERCHANTS, key=("Sk_MaintenanceMerchant",)),
    "services": Contract(S.SERVICES, key=("OrderServiceCode",),
                         refers={"Sk_MaintenanceVehicle": ("vehicles", "Sk_MaintenanceVehicle")}),
}

CONTRACTS = SHEETS | DIMENSIONS


def _typed(have: T.DataType, want: T.StructField) -> tuple[Column, Column]:
    """The column in its contract type (null if it does not read as that), and whether it did not."""
    column = F.col(want.name)
    if isinstance(have, T.DecimalType) and isinstance(want.dataType, T.DecimalType):
        return column, F.lit(False)
    text = F.trim(column) if isinstance(have, T.StringType) and not isinstance(want.dataType, T.StringType) else column
    typed = text.try_cast(want.dataType)
    blank = (text == "") if text is not column else F.lit(False)  # an empty cell is missing, not wrong
    return typed, column.isNotNull() & ~blank & typed.isNull()


def with_faults(df: DataFrame, contract: Contract, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The contract's columns of every row, and ``_faults``, the rules that the row breaks."""
    tables = tables or {}
    lacking = [f.name for f in contract.schema.fields if f.name not in df.columns]
    if lacking:
        raise ValueError(f"missing columns {lacking}; have {df.columns}")
    typed = {f.name: _typed(df.schema[f.name].dataType, f) for f in contract.schema.fields}
    rows = df.select(*[value.alias(name) for name, (value, _) in typed.items()],
                     F.struct(*[bad.alias(name) for name, (_, bad) in typed.items()]).alias("_bad_type"))
    found: dict[str, Column] = {f"type:{name}": F.col(f"_bad_type.`{name}`") for name in typed}
    for c in (*contract.key, *contract.required):
        found[f"missing:{c}"] = F.col(c).isNull()
    for c, values in contract.domains.items():
        found[f"domain:{c}"] = ~F.col(c).isin(*values)
    for c, (least, most) in contract.ranges.items():
        out = F.lit(False)
        out = out if least is None else out | (F.col(c) < F.lit(least))
        found[f"range:{c}"] = out if most is None else out | (F.col(c) > F.lit(most))
    for low, high in contract.ordered:
        found[f"order:{low}<={high}"] = F.col(low) > F.col(high)
    for c, (table, other) in contract.refers.items():
        if table in tables:
            held = tables[table].select(F.col(other).cast(rows.schema[c].dataType).alias(f"_ref_{c}")).distinct()
            rows = rows.join(held, F.col(c) == F.col(f"_ref_{c}"), "left")
            found[f"refers:{c}"] = F.col(c).isNotNull() & F.col(f"_ref_{c}").isNull()
    if contract.key:
        # rows without a whole key are dealt by all they hold, so that they make no one large group
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in contract.key])
        apart = F.when(~whole, F.xxhash64(*contract.schema.names))
        rows = rows.withColumn("_apart", apart).withColumn(
            "_same_key", F.count(F.lit(1)).over(Window.partitionBy(*contract.key, "_apart")))
        found["key"] = whole & (F.col("_same_key") > 1)
    faults = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in found.items()]), lambda f: f.isNotNull())
    return rows.select(*contract.schema.names, faults.alias("_faults"))


@dataclass(frozen=True)
class Governed:
    """A checked sheet: its good rows, the refused ones with ``_faults``, and the counts of the check."""

    accepted: DataFrame
    refused: DataFrame
    rows: int
    n_refused: int
    faults: dict[str, int]

    def require_clean(self) -> DataFrame:
        """The good rows, if there are no others."""
        if self.n_refused:
            raise ValueError(f"{self.n_refused} of {self.rows} rows refused: {self.faults}")
        return self.accepted


def govern(df: DataFrame, kind: str, path: str, tables: Mapping[str, DataFrame] | None = None) -> Governed:
    """Check ``df`` against the contract of ``kind`` and write it below ``path`` (a new folder) in one job."""
    contract, spark = CONTRACTS[kind], df.sparkSession
    checked = with_faults(df, contract, tables).withColumn("_accepted", F.size("_faults") == 0)
    names = contract.faults(tables or {})
    seen = Observation(f"governed-{kind}")
    checked = checked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(~F.col("_accepted"), 1)).alias("refused"), *[
        F.count(F.when(F.array_contains("_faults", name), 1)).alias(f"f{i}") for i, name in enumerate(names)])
    checked.write.partitionBy("_accepted").parquet(path)
    counts = seen.get
    schema = T.StructType([*checked.schema.fields])
    back = spark.read.schema(schema).parquet(path)
    return Governed(back.where("_accepted").select(*contract.schema.names),
                    back.where("NOT _accepted").drop("_accepted"), counts["rows"], counts["refused"],
                    {name: counts[f"f{i}"] for i, name in enumerate(names) if counts[f"f{i}"]})


def read_governed(spark: SparkSession, kind: str, location: str, path: str, fmt: str = "parquet",
                  tables: Mapping[str, DataFrame] | None = None) -> Governed:
    """``govern`` a sheet at ``location``; CSV cells are read as text, so that one bad cell is one fault."""
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    return govern(reader.format(fmt).load(location), kind, path, tables)
