"""Order-clustered storage of the sources that are 1:N with an order.

Services, items, history and protocols are stored as tables bucketed by the
order code, all with the same number of buckets, and partitioned by the
order's period: the month of its last approval-relevant timestamp, or the last
month of the quarter or year that it lies in (0: none, or an order that
services does not have).  Aggregates by order and the joins of
their results then run bucket by bucket without an exchange.  An order counts
on the day of one of those timestamps, so none of an order whose period lies
before a start date can count from then on; ``in_period`` says so to the scan,
and the files of earlier periods are not read.

Each bucket is one sorted file a period.  A hot order is one bucket's file,
read in row-group pieces only where the scan is not bucketed; where one order
holds a large share of all rows, plain tables with their partial aggregates
are the better choice.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratify.sources.catalog import Tables

PERIOD = "order_period"
#: The column that holds the order code.
ORDER_KEYS = {"services": "OrderServiceCode", "items": "MaintenanceId", "history": "cd_manutencao_oficina",
              "protocols": "ProtocolSourceCode"}
APPROVAL_TIMESTAMPS = ["FirstApprovalTimestamp", "SecondApprovalTimestamp", "ThirdApprovalTimestamp",
                       "DisapprovalTimestamp"]


def order_periods(services: DataFrame, months: int = 1) -> DataFrame:
    """_order, order_period of each order code; a period has ``months`` months and is named by its last."""
    _check_months(months)
    return services.groupBy(F.col("OrderServiceCode").alias("_order")).agg(F.max(_period(months)).alias(PERIOD))


def _period(months: int) -> Column:
    """The period of one services row."""
    last = F.to_date(F.greatest(*[F.col(c) for c in APPROVAL_TIMESTAMPS]))
    return F.coalesce(F.year(last) * 100 + F.ceil(F.month(last) / months) * months, F.lit(0)).cast("int")


def _check_months(months: int) -> None:
    if months not in (1, 2, 3, 4, 6, 12):
        raise ValueError(f"a year has no whole number of periods of {months} months")


def write_by_order(t: Tables, prefix: str, path: str, buckets: int, months: int = 1) -> None:
    """Store the sources of ORDER_KEYS below ``path`` and register them as ``<prefix>_<source>``:
    ``buckets`` files for each period of ``months`` months.

    Each source is dealt once, by the writer's own hash, so that every bucket comes from one task.  Services
    are stored first; the other sources look their periods up in the buckets of that table, of which only
    the code and the period are read, by a hash of the bucket's codes.
    """
    _check_months(months)
    for source, key in ORDER_KEYS.items():
        dealt = getattr(t, source).repartition(buckets, key)
        if source == "services":
            own = F.max(_period(months)).over(Window.partitionBy(key))
            placed = dealt.withColumn(PERIOD, F.when(F.col(key).isNotNull(), own).otherwise(F.lit(0)))
        else:
            periods = dealt.sparkSession.table(f"{prefix}_services").select(
                F.col(ORDER_KEYS["services"]).alias("_order"), PERIOD).distinct().hint("shuffle_hash")
            placed = dealt.join(periods, dealt[key] == periods["_order"], "left").select(
                *dealt.columns, F.coalesce(PERIOD, F.lit(0)).alias(PERIOD))
        # dealt already, unless the join had to deal the rows in another way; the writer sorts by period and code itself
        (placed.repartition(buckets, key).write.mode("overwrite").partitionBy(PERIOD)
         .bucketBy(buckets, key).sortBy(key).option("path", f"{path}/{source}").saveAsTable(f"{prefix}_{source}"))


def register_by_order(spark: SparkSession, prefix: str, path: str, buckets: int) -> None:
    """Register what ``write_by_order`` stored below ``path`` in a catalog that does not know it."""
    for source, key in ORDER_KEYS.items():
        fields = spark.read.parquet(f"{path}/{source}").schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {prefix}_{source} ({columns}) USING parquet PARTITIONED BY ({PERIOD}) "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}/{source}'")
        spark.sql(f"ALTER TABLE {prefix}_{source} RECOVER PARTITIONS")


def read_by_order(spark: SparkSession, prefix: str, t: Tables) -> Tables:
    """``t`` with the stored sources in place of its own."""
    return dataclasses.replace(t, **{source: spark.table(f"{prefix}_{source}") for source in ORDER_KEYS})


def in_period(rows: DataFrame, start: dt.date) -> DataFrame:
    """Rows whose order can count from ``start`` on, as far as the storage tells; others as they are."""
    if PERIOD not in rows.columns:
        return rows
    return rows.filter(F.col(PERIOD) >= F.lit(start.year * 100 + start.month)).drop(PERIOD)
