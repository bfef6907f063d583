"""Business rule tables.

Rules that the original pipeline hard-codes in CASE chains are kept here as
small tables; operators join them (broadcast: each has a fixed row count
stated below) instead of spelling out the rules as expressions.  A deployment
can replace any of them with a governed table of the same schema.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the original rules for results to match.
# ---------------------------------------------------------------------------

# Item-count bands: (inclusive upper bound, label); None = open upper band.
ITEM_BANDS = [
    (3, "01-03"),
    (5, "04-05"),
    (7, "06-07"),
    (10, "08-10"),
    (20, "11-20"),
    (30, "21-30"),
    (40, "31-40"),
    (50, "41-50"),
    (None, "50 ou mais"),
]

# Standard minutes per order, by maintenance kind and item band (same band order).
STANDARD_MINUTES = {
    "Corretiva": [8, 12, 14, 20, 25, 35, 45, 55, 65],
    "Preventiva": [6, 8, 10, 14, 18, 25, 45, 55, 65],
    "Sinistro": [12, 18, 21, 30, 38, 53, 68, 83, 98],
}

# Severity thresholds per vehicle family: value < lo -> baixa, lo..hi -> media,
# value > hi -> alta.  Families not listed (or a NULL value) -> alta.
SEVERITY_THRESHOLDS = [
    (["Caminhao Pesado", "Pesado", "Cavalo", "Trator Agricola"], 15000, 35000),
    (["Caminhao", "Implemento", "Onibus", "Micro Onibus", "Reboque"], 5000, 15000),
    (["Pickup Pesada", "Equipamento", "Suv"], 5000, 15000),
    (["Pickup Media"], 3000, 10000),
    (["Pickup Leve"], 2000, 7000),
    (["Van", "Utilitario"], 5000, 15000),
    (["Leve"], 1500, 6000),
    (["Moto", "Quadricilo"], 600, 2000),
]

# Severity labels and their correction factors.
SEVERITY_FACTORS = [
    ("baixa_monta", "1.0"),
    ("media_monta", "1.3"),
    ("alta_monta", "1.5"),
    ("Preventiva", "1.0"),
]

# Maintenance kinds and the type / description values that select them.
KIND_CLAIM = "Sinistro"
KIND_PREVENTIVE = "Preventiva"
KIND_CORRECTIVE = "Corretiva"

# Vehicle family fallbacks.
FAMILY_UNKNOWN = ["Nao Identificado", "Nao Definido"]
CATEGORY_UNKNOWN = ["Nao Identificado"]
FAMILY_DEFAULT = "Leve"

# Customers with public-market extra minutes, and the one special customer.
PUBLIC_MARKET_CUSTOMERS = [
    230011, 232129, 233980, 233985, 235548, 235550, 235552,
    240752, 231037, 231038, 231039, 231040, 231048, 231051,
    231052, 231055, 234455, 234456, 234913, 187966,
]
SPECIAL_CUSTOMER = 233898

# Labor names whose items count for price adherence.
ADHERENCE_LABORS = [
    "SUBSTITUIR",
    "SUBSTITUIR COM REVISAO CUBO",
    "SUBSTITUIR SEM REVISAO CUBO",
    "FORNECIMENTO DE PECAS",
]
DEALERSHIP_MERCHANT_TYPE = "Concessionaria"
MIN_UNIT_PRICE = Decimal("0.1")
MIN_QUANTITY = Decimal("1")

# Change-log parameter holding the partner-price approver list.
PARTNER_PRICE_PARAMETER_ID = 586
PARTNER_PRICE_FACTOR = Decimal("1.1")

# Daily working minutes the weight is normalised by (7.48 h).
DAILY_MINUTES = Decimal("448.80")

# History event codes: review and quote interactions.
EVENT_REVIEW = 11
EVENT_QUOTE = 14
MINUTES_PER_REVIEW = 5
MINUTES_PER_QUOTE = 5
SPECIAL_QUOTE_CAP_AT = 3
SPECIAL_QUOTE_CAP = 15
PUBLIC_MARKET_BASE = 5
SPECIAL_ITEM_MULTIPLIER = Decimal("1.5")

# Calendar: days kept as approval days, and the open interval end.
BRIDGE_LABEL = "Bridge"
OPEN_END = "9999-12-31 23:59:59"
DEFAULT_START_DATE = "2025-01-01"
LAST_WEEKDAY = 4           # Monday = 0 ... Friday = 4
LAST_WEEKDAY_ROSTER = 5    # roster members also work Saturday

# ---------------------------------------------------------------------------
# Our own parameters (not from the original): business hours for the SLA.
# ---------------------------------------------------------------------------
WORKDAY_START_MINUTE = 8 * 60
WORKDAY_END_MINUTE = 18 * 60


# ---------------------------------------------------------------------------
# Rule tables as DataFrames
# ---------------------------------------------------------------------------

def item_band_table(spark: SparkSession) -> DataFrame:
    """(lower, upper, label): ``upper`` NULL = open band. 9 rows."""
    rows, lower = [], None
    for upper, label in ITEM_BANDS:
        rows.append((lower, upper, label))
        lower = upper + 1 if upper is not None else None
    return literal_table(spark, rows, "lower int, upper int, label string")


def standard_minutes_table(spark: SparkSession) -> DataFrame:
    """(kind, band, minutes). 27 rows."""
    rows = [
        (kind, label, minutes)
        for kind, per_band in STANDARD_MINUTES.items()
        for (_, label), minutes in zip(ITEM_BANDS, per_band)
    ]
    return literal_table(spark, rows, "kind string, band string, minutes int")


def severity_threshold_table(spark: SparkSession, scale: int = 1) -> DataFrame:
    """(family, lo, hi) as decimal(18,2); ``scale`` multiplies both bounds. 19 rows."""
    rows = []
    seen = set()
    for families, lo, hi in SEVERITY_THRESHOLDS:
        for fam in families:
            if fam in seen:
                continue
            seen.add(fam)
            rows.append((fam, Decimal(lo * scale), Decimal(hi * scale)))
    return literal_table(spark, rows, "family string, lo decimal(18,2), hi decimal(18,2)")


def severity_factor_table(spark: SparkSession) -> DataFrame:
    """(severity, factor decimal(2,1)). 4 rows."""
    return literal_table(spark, [(s, Decimal(f)) for s, f in SEVERITY_FACTORS],
                         "severity string, factor decimal(2,1)")


def customer_rule_table(spark: SparkSession) -> DataFrame:
    """(customer_id, class) with class 'public' or 'special'. 21 rows."""
    rows = [(c, "public") for c in PUBLIC_MARKET_CUSTOMERS] + [(SPECIAL_CUSTOMER, "special")]
    return literal_table(spark, rows, "customer_id long, class string")


def labor_whitelist_table(spark: SparkSession) -> DataFrame:
    """(labor_name). 4 rows."""
    return literal_table(spark, [(n,) for n in ADHERENCE_LABORS], "labor_name string")


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float, Decimal)):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


_LITERAL_CACHE: dict = {}


def literal_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small fixed table built from literals, as one ``VALUES`` relation.

    A local relation carries exact size statistics, so the optimizer
    broadcasts it in joins (a Python-list ``createDataFrame`` has none and
    would be planned as a shuffle join).  Tables are cached per session.
    """
    key = (id(spark), spark.sparkContext.applicationId, ddl, tuple(rows))
    hit = _LITERAL_CACHE.get(key)
    if hit is not None:
        return hit
    schema = T._parse_datatype_string(ddl)
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    cols = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`"
                     for i, f in enumerate(schema.fields))
    aliases = ", ".join(f"c{i}" for i in range(len(names)))
    df = spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({aliases})")
    _LITERAL_CACHE[key] = df
    return df
