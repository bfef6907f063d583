"""Scheduled refresh (S6) as an incremental Structured Streaming job.

New service-order files land in a folder.  A file-source stream with
``trigger(availableNow=True)`` picks up exactly the files not seen by earlier
runs (the stream checkpoint records them), and ``foreachBatch`` re-runs the
fact for the approval months those orders can touch, overwriting only those
month partitions (``run_refresh``, orders only).  ``run_changes`` does the same
for new rows of every source.  Run it on a schedule (daily): each run processes what
arrived since the last one, then stops.  A failed run is simply re-run: the
batch write is an idempotent partition overwrite and the checkpoint only
advances after it succeeds.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ratify.operators.changes import CHANGE_KEYS, touched_months, touched_orders
from ratify.plans.fact import FactOptions
from ratify.session import ensure_checkpoint_dir
from ratify.sources.catalog import Tables
from ratify.sources.schemas import SOURCE_SCHEMAS
from ratify.sources.sinks import held_months, read_fact, refresh_fact, refresh_months
from ratify.sources.versions import VersionedTable, delete_folder

# Stage timestamps that can set an order's approval date.
APPROVAL_TIMESTAMPS = ["FirstApprovalTimestamp", "SecondApprovalTimestamp",
                       "ThirdApprovalTimestamp", "DisapprovalTimestamp"]


def earliest_touched_day(batch: DataFrame) -> dt.date | None:
    """Earliest approval-relevant day among the new orders (one scalar aggregate)."""
    cols = [c for c in APPROVAL_TIMESTAMPS if c in batch.columns]
    if not cols:
        return None
    row = batch.select(F.least(*[F.to_date(c) for c in cols]).alias("d")).agg(
        F.min("d").alias("d")).first()
    return row["d"] if row else None


def run_refresh(spark: SparkSession, landing_dir: str, schema: T.StructType,
                load_tables: Callable[[], Tables], out_path: str | VersionedTable, opts: FactOptions,
                checkpoint: str | None = None) -> list[list[int]]:
    """Process the order files landed since the previous run; returns, per
    micro-batch, the approval months rewritten."""
    base = checkpoint or os.path.join(ensure_checkpoint_dir(spark), "ratify-refresh")
    written: list[list[int]] = []

    def old_day(batch: DataFrame) -> dt.date | None:
        """Earliest day on which the table holds one of the batch's orders (they may have moved)."""
        try:
            held = read_fact(spark, out_path)
        except (AnalysisException, ValueError):  # the first run: no table yet
            return None
        hit = held.join(batch.select("OrderServiceCode").distinct(), "OrderServiceCode", "left_semi")
        return hit.agg(F.min("data_aprovacao").alias("d")).first()["d"]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        days = [d for d in (earliest_touched_day(batch), old_day(batch)) if d is not None]
        if not days:
            return
        since = min(d.date() if isinstance(d, dt.datetime) else d for d in days)
        written.append(refresh_fact(spark, load_tables(), out_path, opts, since=since))

    query = (spark.readStream.schema(schema).parquet(landing_dir)
             .writeStream.trigger(availableNow=True)
             .option("checkpointLocation", base)
             .foreachBatch(on_batch).start())
    query.awaitTermination()
    return written


def run_changes(spark: SparkSession, landing: dict[str, str], load_tables: Callable[[], Tables],
                out_path: str | VersionedTable, opts: FactOptions) -> list[int]:
    """Bring the fact at ``out_path`` up to date with the files landed since the last run in the folder of
    any source (``landing``: source name to folder); returns the months rewritten.

    One stream a source reads what is new; its offsets are its checkpoint in
    ``<out_path>/_refresh/offsets``.  A batch leaves the keys of its rows in
    ``_refresh/pending``, named by source and batch, so a repeated batch writes
    the same folder.  Then the pending keys of all sources become one set of
    touched orders, their months are recomputed from the tables as they are
    now, and the pending keys go.  A run that fails anywhere before leaves them
    for the next one, which recomputes the same months.  Without a stored fact
    all months are computed.  Into a ``VersionedTable`` a run is one commit.
    """
    state = f"{str(out_path).rstrip('/')}/_refresh"
    for source, folder in landing.items():
        _collect_keys(spark, source, folder, state)
    changed = _pending(spark, landing, state)
    if not held_months(spark, out_path):
        months = refresh_fact(spark, load_tables(), out_path, opts)
    elif changed:
        tables = load_tables()
        touched = touched_orders(changed, tables).persist()
        held = read_fact(spark, out_path).select("OrderServiceCode", "data_aprovacao")
        concerned = touched_months(touched, tables, held)
        refresh_months(spark, tables, out_path, opts, concerned)
        touched.unpersist()
        months = sorted(concerned)
    else:
        months = []
    delete_folder(spark, f"{state}/pending")
    return months


def _collect_keys(spark: SparkSession, source: str, folder: str, state: str) -> None:
    keys = CHANGE_KEYS[source]

    def on_batch(batch: DataFrame, number: int) -> None:
        batch.select(*keys).distinct().write.mode("overwrite").parquet(f"{state}/pending/{source}/batch={number}")

    query = (spark.readStream.schema(SOURCE_SCHEMAS[source]).parquet(folder).writeStream.trigger(availableNow=True)
             .option("checkpointLocation", f"{state}/offsets/{source}").foreachBatch(on_batch).start())
    query.awaitTermination()


def _pending(spark: SparkSession, landing: dict[str, str], state: str) -> dict[str, DataFrame]:
    """The keys that no refresh has taken in yet, by source."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    out = {}
    for source in landing:
        folder = path(f"{state}/pending/{source}")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            schema = T.StructType([f for f in SOURCE_SCHEMAS[source].fields if f.name in CHANGE_KEYS[source]])
            out[source] = spark.read.schema(schema).parquet(folder.toString())
    return out
