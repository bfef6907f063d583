"""Helpers shared by the corpus operators: scratch tables, text passes, cuts."""

from __future__ import annotations

import functools
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ratify.session import ensure_checkpoint_dir

#: White space of the word contracts: blank and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: Stands for a null id where ids are keys; sorts after every real id.
NO_ID = 2**63 - 1
#: Settings under which tables with one sorted file a bucket are read and merged as they should be.  The first lets a
#: scan count as sorted (off by default, since buckets may have several files).  Without the second a union of bucketed
#: scans counts as dealt, the planner drops the repartition above it and then reads the scans without their
#: buckets, so that a merged table would get several files a bucket.
SORTED_SCANS = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
                "spark.sql.unionOutputPartitioning": "false"}
_LAST_CUT = regex.compile(r"(?r)(?<=\S)(?=\s)")
_CUT = re.compile(r"(?<=\S)(?=\s)")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so that
    a lost executor costs only the tasks that read from it, never a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote and nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = hadoop(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def sorted_scans(spark: SparkSession) -> Iterator[None]:
    """For plans that read or merge tables of sorted buckets (see ``SORTED_SCANS``)."""
    before = {key: spark.conf.get(key, None) for key in SORTED_SCANS}
    for key, value in SORTED_SCANS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def id_key(column: str = "doc_id") -> Column:
    """The id as a join key without nulls."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once for each application, in case they do not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_ratify_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="ratify-"), "ratify_package"), "zip", root, "ratify")
    context.addPyFile(archive)
    context._ratify_shipped = True


_kept: dict = {}


def kept(make: Callable, *args):
    """``make(*args)``, kept by this worker until it asks for something else: a worker that goes on
    to another operator does not carry along what the one before remembered."""
    key = (make, *args)
    if key not in _kept:
        _kept.clear()
        _kept[key] = make(*args)
    return _kept[key]


def _tidy(fn: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``fn``; at the end the worker gives Arrow's free memory back."""
    yield from fn(batches)
    pa.default_memory_pool().release_unused()


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with the package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(functools.partial(_tidy, fn), schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a schema string; for the driver, which hands it to the tasks."""
    return to_arrow_schema(T._parse_datatype_string(ddl))


def map_texts(docs: DataFrame, factory: Callable[[], Callable[[Iterable[str]], list]], schema: str,
              id_col: str = "doc_id", text_col: str = "text", kind: str = "string") -> DataFrame:
    """One pass over whole texts (or values of another ``kind``) in Arrow batches.

    ``factory`` builds, in the worker, a function from the texts of a batch
    (null: empty) to one list per column of ``schema``; the result has the id
    in front.  Other columns of ``docs`` are not read.
    """
    fields = T.StructType().add("doc_id", T.LongType())
    for field in T._parse_datatype_string(schema).fields:
        fields.add(field)
    arrow, empty = to_arrow_schema(fields), b"" if kind == "binary" else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = factory()
        for batch in batches:
            columns = work(value.as_py() or empty for value in batch.column(1))
            arrays = [pa.array(c, type=f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=arrow)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast(kind).alias("text")),
                     run, fields)


def stable_cut(text: str, start: int) -> int:
    """First place from ``start`` on where white space follows another character.

    No match of the pre-token pattern spans such a place and none looks back
    over it, so both sides can be split into pre-tokens separately.  The
    text's length if there is none.
    """
    found = _CUT.search(text, max(start, 1))
    return found.start() if found else len(text)


def middle_cut(text: str) -> int:
    """The stable place next after the middle, else the last one before it, else the length."""
    cut = stable_cut(text, len(text) // 2)
    if cut == len(text) and (found := _LAST_CUT.search(text, 1, len(text) // 2)):
        cut = found.start()
    return cut


def text_chunks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut at stable places."""
    at = 0
    while at < len(text):
        end = len(text) if len(text) - at <= size else stable_cut(text, at + size)
        yield text[at:end]
        at = end


def byte_chunks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes in pieces of about ``size``, cut where ASCII white space begins."""
    space, at = re.compile(rb"[\x20\x09-\x0d]"), 0
    while at < len(data):
        end = len(data)
        if end - at > size and (found := space.search(data, at + size)):
            end = found.start()
        yield data[at:end]
        at = end
