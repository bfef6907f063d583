"""LEAD within a group, without putting a whole group in one task.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task;
if one key holds a large share of all rows, that task does the whole job.
``next_in_group`` looks for the next row inside (key, bucket), where the
bucket is a rising function of the first order column (a month, say).  The
last row of a bucket takes its next values from the first row of the key's
next bucket that has rows: a window over at most one row for each key and
bucket.  The buckets follow from the rows alone, so there is one plan at
every size, nothing is sampled, and no lineage has to be cut.

All steps are built-in Spark operators (no Python in the data path).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def month_bucket(ts: Column | str) -> Column:
    """Months since year 0: rises with the timestamp (NULL stays NULL and sorts first)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(ts) * 12 + F.month(ts)


def next_in_group(df: DataFrame, keys: list[str], order: list[Column | str], values: list[str],
                  bucket: Column, prefix: str = "next_") -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` in the following row of the same
    ``keys`` group ordered by ``order`` (NULL for the group's last row).

    ``bucket`` must not fall when the first order column rises.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # dealt once by (key, bucket): both branches read this exchange, so the rows are built once
    rows = df.withColumn("_sq_bucket", bucket).repartition(*keys, "_sq_bucket")
    w = Window.partitionBy(*keys, "_sq_bucket").orderBy(*order_cols)
    local = rows.select(
        "*", *[F.lead(v).over(w).alias(f"_sq_n_{v}") for v in values],
        F.lead(F.lit(1)).over(w).isNull().alias("_sq_last"))
    # structs compare field by field, nulls first, as the window's order does
    # (a value that is an order column is in the struct once)
    ordered = {c: f"o{i}" for i, c in enumerate(order) if isinstance(c, str)}
    fields = {v: ordered.get(v, f"v{i}") for i, v in enumerate(values)}
    first = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_cols)],
                     *[F.col(v).alias(f) for v, f in fields.items() if v not in ordered])
    heads = rows.groupBy(*keys, "_sq_bucket").agg(F.min(first).alias("_sq_head"))
    after = heads.select(
        *[F.col(k).alias(f"_sq_k_{k}") for k in keys], F.col("_sq_bucket").alias("_sq_k"),
        F.lead("_sq_head").over(Window.partitionBy(*keys).orderBy("_sq_bucket")).alias("_sq_after"))
    cond = reduce(lambda a, b: a & b, [local[k].eqNullSafe(after[f"_sq_k_{k}"]) for k in keys]
                  + [local["_sq_bucket"].eqNullSafe(after["_sq_k"])])
    joined = local.join(after, cond, "left")
    return joined.select(*df.columns, *[
        F.when(F.col("_sq_last"), F.col(f"_sq_after.{fields[v]}")).otherwise(F.col(f"_sq_n_{v}")).alias(prefix + v)
        for v in values])
