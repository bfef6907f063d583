"""Membership intervals kept as state, brought forward by slices of the change log.

``membership_intervals`` parses and leads the whole log.  Here a slice of the
log meets only what the past has left open: the last event of each (client,
member).  An event of the slice closes that one and those before it; the last
of the slice stays open in turn.

A state folder holds, for each slice number, the events that the slice put in
order (``ordered``), and the open event of every (client, member) after it
(``heads``).  An ordered event counts once its successor is known; both are
written before the number is committed, so a run that
fails leaves the state as it was and its folders are written over by the next.
Ordered events are never rewritten.

A slice may only continue a (client, member): an event that is not later than
the open one is late.  Late events are refused as a whole slice
(``late="refuse"``) or replayed: the events of the (client, member) that have
late ones are put in order again with all they had, written with the slice,
and their earlier rows no longer count (``replayed``).  Any split of a log
into slices, in any order, thus ends in the intervals of one run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratify.operators.changelog import intervals_of, membership_changes, membership_events, order_events
from ratify.sources import rules as R

KEYS = ["CodigoCliente", "approver"]
EVENT = ["CodigoCliente", "approver", "event_type", "ts"]


class LateEvents(ValueError):
    """A slice has events that are not later than the open ones."""


def _same_key(a: DataFrame, b: DataFrame):
    return a["CodigoCliente"].eqNullSafe(b["CodigoCliente"]) & a["approver"].eqNullSafe(b["approver"])


class IntervalState:
    """The state in ``path``; a new folder is an empty state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def latest(self) -> int:
        """Number of committed slices."""
        fs, folder = self._fs(f"{self.path}/committed")
        return max((int(f.getPath().getName()) for f in fs.listStatus(folder)), default=0) if fs.exists(folder) else 0

    def _write(self, df: DataFrame, part: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/slice={number}")

    def _read(self, part: str, number: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}/slice={number}")

    def _closed(self, number: int) -> DataFrame:
        """The closed events that count after slice ``number``."""
        rows = again = None
        for n in range(1, number + 1):
            rows = _plus(rows, self._read("ordered", n).where("next_event_type IS NOT NULL").withColumn("_slice", F.lit(n)))
            again = _plus(again, self._read("replayed", n).withColumn("_from", F.lit(n)))
        last = again.groupBy(*KEYS).agg(F.max("_from").alias("_from"))
        return rows.join(last, _same_key(rows, last) & (rows["_slice"] < last["_from"]), "left_anti").drop("_slice")

    def apply(self, log_slice: DataFrame, parameter_id: int | None = R.PARTNER_PRICE_PARAMETER_ID,
              strip_whitespace: bool = True, late: str = "refuse") -> int:
        """Take in a slice of the change log; the number of slices then committed."""
        if late not in ("refuse", "replay"):
            raise ValueError(f"unknown rule for late events {late!r}")
        number = self.latest()
        events = membership_events(membership_changes(log_slice, parameter_id, strip_whitespace)).select(*EVENT)
        if not number:
            self._write(events.select(*KEYS).limit(0), "replayed", 1)
            return self._commit(order_events(events), None, 1)
        heads = self._read("heads", number)
        open_ = heads.select(*KEYS, F.col("ts").alias("_open"))
        # without a time an event cannot be placed behind another; a null open event is before all
        of_slice = events.join(open_, _same_key(events, open_), "inner")
        behind = of_slice.where((events["ts"] <= F.col("_open")) | events["ts"].isNull()).select(
            *[events[k] for k in KEYS]).distinct()
        self._write(behind, "replayed", number + 1)
        behind = self._read("replayed", number + 1)
        some_late = not behind.isEmpty()
        if some_late and late == "refuse":
            raise LateEvents(f"{behind.count()} (client, member) have events that are not later than their open one")
        past = heads.select(*EVENT)
        if some_late:
            closed = self._closed(number).select(*EVENT)
            past = past.unionByName(closed.join(behind, _same_key(closed, behind), "left_semi"))
        touched = events.select(*KEYS).distinct()
        past = past.join(touched, _same_key(past, touched), "left_semi")
        rest = heads.join(touched, _same_key(heads, touched), "left_anti")
        return self._commit(order_events(past.unionByName(events)), rest, number + 1)

    def _commit(self, ordered: DataFrame, rest: DataFrame | None, number: int) -> int:
        """Write the ordered events, then the open ones among them with the ``rest``, then the number."""
        self._write(ordered, "ordered", number)
        heads = self._read("ordered", number).where("next_event_type IS NULL").select(*EVENT)
        self._write(heads if rest is None else heads.unionByName(rest), "heads", number)
        fs, folder = self._fs(f"{self.path}/committed/{number}")
        fs.mkdirs(folder)
        return number

    def ordered(self) -> DataFrame:
        """All events with next_ts and next_event_type, as ``order_events`` gives them for the whole log."""
        number = self.latest()
        if not number:
            raise ValueError(f"no slice has been taken into {self.path}")
        open_ = self._read("heads", number)
        closed = self._closed(number)
        return closed.unionByName(open_.select(*EVENT, F.lit(None).cast(closed.schema["next_ts"].dataType).alias("next_ts"),
                                               F.lit(None).cast("string").alias("next_event_type")))

    def intervals(self, users: DataFrame) -> DataFrame:
        """The columns of ``membership_intervals``."""
        return intervals_of(self.ordered(), users)


def _plus(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)
