"""Line dedup over levelled sorted runs of line hashes.

The index is a folder of runs, tables bucketed and sorted by line hash with
one file a bucket, each hash with the smallest id that holds it; commit files
(``ratify.sources.versions``) name the runs of each level, so a later session
opens the index by its path and a batch that fails half-way adds nothing.  A
batch of documents is reduced to its distinct hashes, dealt once, and
merge-anti-joined with every run, whose side is neither shuffled nor sorted:
hashes that no run has are new and become a run of level 0.  Once a level has
``fanout`` runs, they are merged into one run of the next level, sorted
again, so a batch meets few runs and a hash is rewritten once for each level.
Runs never share a hash.  Batches come in ascending order of ids, so the first
owner of a hash is the smallest id that holds it; an index that is kept goes
on in the same order (``add`` refuses nothing, the first owner stays).

Defined results: null or empty text is one empty line; lines whose key is
under ``least`` code points are never touched; rows with equal ids count as
one document; a null id counts as one document after all others; an empty
table gives an empty table; other columns pass through ``dedup_lines`` and
are ignored by ``line_figures``.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratify.llm.common import NO_ID, SPACES, id_key, map_arrow, materialise, scratch_path, sorted_scans
from ratify.sources import versions

# Fixed value: keys of fewer code points are no duplicates.
LEAST = 10


def line_key(line: str, least: int = LEAST) -> bytes | None:
    """Hash of a line's key (blank ends stripped, A-Z in lower case); None if the key is short."""
    bare = line.strip(SPACES)
    return xxhash.xxh3_128_digest(bare.encode().lower()) if len(bare) >= least else None


def _emit_keys(least: int, batches):
    """(doc, key): the distinct keys of each document."""
    for batch in batches:
        docs, keys = [], []
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            own = {line_key(line, least) for line in (text.as_py() or "").split("\n")} - {None}
            docs += [doc.as_py()] * len(own)
            keys += sorted(own)
            if len(keys) > 100_000:
                yield _pairs(docs, keys)
                docs, keys = [], []
        yield _pairs(docs, keys)


def _pairs(docs: list, keys: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(keys, pa.binary())], names=["doc", "key"])


def line_keys(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, key: one row for each distinct key of each row of ``docs``."""
    return map_arrow(docs.select(id_key(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")),
                     functools.partial(_emit_keys, least), "doc long, key binary")


class LineIndex:
    """The index below ``path``, made empty if there is none; ``levels[i]`` names the runs of level i.

    ``fanout`` and the number of buckets are those of its making.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = 4, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if not versions.commits(spark, self.path):
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            versions.commit(spark, self.path, 1, {"buckets": buckets, "fanout": fanout, "levels": [[]]})
        self._open()

    def _open(self) -> None:
        self.number, content = versions.newest(self.spark, self.path)
        self.buckets, self.fanout, self.levels = content["buckets"], content["fanout"], content["levels"]

    def _commit(self, levels: list[list[str]]) -> None:
        versions.commit(self.spark, self.path, self.number + 1,
                        {"buckets": self.buckets, "fanout": self.fanout, "levels": levels})
        self._open()

    def _table(self, name: str) -> str:
        """The run's name in the catalog, which gets to know it here if another session wrote it."""
        table = f"line_index_{hashlib.sha256(self.path.encode()).hexdigest()[:12]}_{name}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} (key BINARY, owner BIGINT) USING parquet CLUSTERED BY (key) "
                           f"SORTED BY (key) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return table

    def _write(self, rows: DataFrame) -> str:
        """A new run of (key, owner) rows, which are dealt by key into the buckets; one task writes one bucket, in order."""
        name = f"r{uuid.uuid4().hex}"
        (rows.select("key", "owner").sortWithinPartitions("key").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "key").sortBy("key").saveAsTable(self._table(name)))
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def runs(self) -> list[DataFrame]:
        return [self._run(name) for level in self.levels for name in level]

    def owners(self) -> DataFrame:
        """key, owner: every hash with the id that owns it."""
        runs = self.runs()
        if not runs:
            return self.spark.range(0).select(F.lit(b"").alias("key"), F.col("id").alias("owner"))
        return functools.reduce(DataFrame.unionAll, runs)

    def lacking(self, fresh: DataFrame) -> DataFrame:
        """The (key, owner) rows whose key no run has (planned inside ``sorted_scans``)."""
        dealt = fresh.repartition(self.buckets, "key")
        return functools.reduce(lambda left, run: left.join(run.hint("merge"), "key", "left_anti"), self.runs(), dealt)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc, key) rows: its new hashes become a run, then levels are compacted."""
        self._open()
        fresh = keys.groupBy("key").agg(F.min("doc").alias("owner"))
        with sorted_scans(self.spark):
            new = self._write(self.lacking(fresh))
        self._commit([[*self.levels[0], new], *self.levels[1:]])
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                self._merge(level)
            level += 1

    def _merge(self, level: int) -> None:
        """The runs of a level as one run of the next."""
        together = functools.reduce(DataFrame.unionAll, [self._run(name) for name in self.levels[level]])
        with sorted_scans(self.spark):
            merged = self._write(together.repartition(self.buckets, "key"))
        levels = [list(names) for names in self.levels] + [[]]
        levels[level], levels[level + 1] = [], [*levels[level + 1], merged]
        self._commit(levels if levels[-1] else levels[:-1])

    def clean_up(self) -> list[str]:
        """Delete the runs that the last commit does not name, when no plan reads them any more; their names."""
        self._open()
        used = {name for level in self.levels for name in level}
        gone = [n for n in versions.entries(self.spark, self.path) if n.startswith("r") and n not in used]
        for name in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            versions.delete_folder(self.spark, f"{self.path}/{name}")
        return gone


def duplicate_lines(docs: DataFrame, batches: int = 4, fanout: int = 4, least: int = LEAST, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc, keys: for each document the hashes whose lines it loses (a smaller id owns them).

    The batches are ranges of ids; a job hashes all lines once, the batches
    read the hashes back.
    """
    spark = docs.sparkSession
    keys = materialise(line_keys(docs, least, id_col, text_col), "line-keys")
    shares = [i / batches for i in range(1, batches)]
    cuts = keys.where(F.col("doc") < NO_ID).agg(F.percentile_approx("doc", shares, 1000)).first()[0] if shares else None
    bounds = [None, *sorted(set(cuts or [])), None]
    index = LineIndex(spark, scratch_path(spark, "line-index"), fanout)
    for low, high in zip(bounds, bounds[1:], strict=False):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (F.col("doc") > low)
        if high is not None:
            inside = inside & (F.col("doc") <= high)
        index.add(keys.where(inside))
        index.clean_up()
    lost = keys.join(index.owners(), "key").where(F.col("owner") < F.col("doc"))
    return lost.groupBy("doc").agg(F.collect_set("key").alias("lost_keys"))


def _with_lost(docs: DataFrame, lost: DataFrame, id_col: str, text_col: str) -> DataFrame:
    left = docs.select(id_key(id_col).alias("doc"), F.struct(*docs.columns).alias("row"))
    return left.join(lost, "doc", "left").select(
        "row", F.col(f"row.`{text_col}`").cast("string").alias("text"), "lost_keys")


def _drop(text: str, lost: set, least: int) -> tuple[int, int, str]:
    lines = text.split("\n")
    if not lost:
        return len(lines), 0, text
    kept = [line for line in lines if line_key(line, least) not in lost]
    return len(lines), len(lines) - len(kept), "\n".join(kept)


def _figures(least: int, batches):
    for batch in batches:
        counted: list = [[], [], []]
        for text, lost in zip(batch.column(1), batch.column(2), strict=True):
            n, dropped, kept = _drop(text.as_py() or "", set(lost.as_py() or ()), least)
            for column, value in zip(counted, (n, dropped, hashlib.sha256(kept.encode()).hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counted[0], pa.int64()), pa.array(counted[1], pa.int64()),
             pa.array(counted[2], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_figures(docs: DataFrame, batches: int = 4, least: int = LEAST, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    lean = docs.select(id_col, text_col)
    lost = duplicate_lines(lean, batches, least=least, id_col=id_col, text_col=text_col)
    rows = _with_lost(lean, lost, id_col, text_col).select(
        F.col(f"row.`{id_col}`").cast("long").alias("doc_id"), "text", "lost_keys")
    return map_arrow(rows, functools.partial(_figures, least),
                     "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _rewrite(least: int, batches):
    for batch in batches:
        kept = [_drop(t.as_py() or "", set(k.as_py() or ()), least)[2]
                for t, k in zip(batch.column(1), batch.column(2), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["row", "text"])


def dedup_lines(docs: DataFrame, batches: int = 4, least: int = LEAST) -> DataFrame:
    """The documents with their text (and n_chars, if there) after the duplicate lines went."""
    lost = duplicate_lines(docs, batches, least=least)
    rows = _with_lost(docs, lost, "doc_id", "text")
    others = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars")]
    lean = rows.select(F.struct(*others).alias("row"), "text", "lost_keys")
    schema = f"row {lean.schema['row'].dataType.simpleString()}, text string"
    out = map_arrow(lean, functools.partial(_rewrite, least), schema)
    column = {c: F.col(f"row.`{c}`").alias(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        column["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*(column[c] for c in docs.columns))
