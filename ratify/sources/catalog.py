"""Readers: catalog tables (S1) and governed parameter tables.

``Tables`` bundles the source DataFrames a plan needs.  Readers select only
the contract columns (see ``schemas``), so Parquet scans are pruned to them,
and cast to the contract types so the plan never depends on the upstream's
physical types.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratify.sources.schemas import PARAMETER_SCHEMAS, SOURCE_SCHEMAS


@dataclass
class Tables:
    """Source tables of the approval plan (domain names)."""

    services: DataFrame
    items: DataFrame
    users: DataFrame
    dates: DataFrame
    vehicles: DataFrame
    types: DataFrame
    statuses: DataFrame
    protocols: DataFrame
    attendances: DataFrame
    history: DataFrame
    param_log: DataFrame
    labors: DataFrame
    merchants: DataFrame
    # parameter tables
    roster: DataFrame | None = None
    customer_rules: DataFrame | None = None
    hierarchy: DataFrame | None = None
    audit: DataFrame | None = None
    sla_target: DataFrame | None = None
    extra: dict = field(default_factory=dict)

    def names(self) -> list[str]:
        return [f.name for f in fields(self) if f.name != "extra"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the contract columns; fail on a missing column."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[_as_contract(df.schema[f.name].dataType, f).alias(f.name) for f in schema.fields])


def _as_contract(have: T.DataType, want: T.StructField):
    """The column in its contract type; a decimal keeps its own scale, so no price is rounded."""
    column = F.col(want.name)
    if isinstance(have, T.DecimalType) and isinstance(want.dataType, T.DecimalType):
        return column
    return column.cast(want.dataType)


def read_source(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Read one source: ``location`` is a catalog table name or a Parquet path."""
    schema = SOURCE_SCHEMAS[name]
    if "/" in location or location.endswith(".parquet"):
        df = spark.read.parquet(location)
    else:
        df = spark.table(location)
    return conform(df, schema)


def read_sources(spark: SparkSession, locations: dict[str, str]) -> Tables:
    """Read all thirteen sources from a {name: table-or-path} mapping."""
    dfs = {name: read_source(spark, name, loc) for name, loc in locations.items()}
    return Tables(**dfs)


def read_parameter_table(spark: SparkSession, kind: str, path: str, fmt: str = "parquet",
                         check_unique: bool = True) -> DataFrame:
    """Read a governed parameter table (roster, hierarchy, targets, ...).

    The sheet is cast to its declared schema (a renamed or missing column
    fails here, not deep inside a report) and, when the kind has a key, the
    key is checked for duplicates with one distributed aggregate.
    """
    schema, key = PARAMETER_SCHEMAS[kind]
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", "true").schema(schema)
    df = conform(reader.format(fmt).load(path), schema)
    if check_unique and key:
        dup = df.groupBy(*key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"{kind}: duplicate key {key} = {dup[0][:len(key)]}")
    return df
