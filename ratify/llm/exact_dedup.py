"""Exact dedup against a persistent digest index, DataFrame functions only.

A text's digest is the SHA-256 of the text without white space.  The index is
a folder of generations, each a table bucketed and sorted by digest with one
file a bucket, that hold for each digest the row that stays; commit files
(``ratify.sources.versions``) name the generations that count, so a later
session opens the index by its path and a batch that fails half-way adds
nothing.  A batch is reduced to one candidate row for each digest (with a
partial aggregate, so that a group of copies shrinks in each task before the
shuffle), sort-merge anti-joined with every generation, and what the index
lacks is appended as a generation of its own.  The index side of these joins
is neither shuffled nor sorted; the batch is dealt once.  Once there are more
than ``MOST`` generations they are merged into one.  Rows then find their group
by digest; that join is an inner sort-merge join, of which Spark splits hot
digests.

Of equal texts in one batch the row with the most code points stays, then the
smallest id; a text that an earlier batch brought stays with its earlier row.

Defined results: null text counts as empty, and all texts without other
characters are equal; a null id sorts after every id; rows that repeat an id
are rows of their own in ``group_size`` and share ``kept``; an empty table
gives an empty table; other columns are ignored.  Of two sessions that add to
one index at a time the second one is refused (``CommitConflict``).
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratify.llm.common import NO_ID, SPACES, id_key, materialise, scratch_path, sorted_scans
from ratify.sources import versions

#: Generations of an index before they are merged into one.
MOST = 8


def normalised(text_col: str = "text") -> Column:
    """The text (null: empty) without white space."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return reduce(lambda t, space: F.replace(t, F.lit(space), F.lit("")), SPACES, text)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, digest, n_points (code points of the original text) of every row."""
    return docs.select(id_key(id_col).alias("doc"), F.sha2(normalised(text_col), 256).alias("digest"),
                       F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).alias("n_points"))


class DigestIndex:
    """The index below ``path``, which is made empty if it does not exist; the number of buckets is that of its making."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if not versions.commits(spark, self.path):
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            empty = spark.range(0).select(F.lit("").alias("digest"), F.col("id").alias("keep"))
            versions.commit(spark, self.path, 1, {"buckets": self.buckets, "generations": [self._write(empty)]})
        self._open()

    def _open(self) -> None:
        self.number, content = versions.newest(self.spark, self.path)
        self.buckets, self.names = content["buckets"], content["generations"]

    def _table(self, name: str) -> str:
        """The generation's name in the catalog, which gets to know it here if another session wrote it."""
        table = f"digest_index_{hashlib.sha256(self.path.encode()).hexdigest()[:12]}_{name}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} (digest STRING, keep BIGINT) USING parquet CLUSTERED BY (digest) "
                           f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return table

    def _write(self, rows: DataFrame) -> str:
        """A new generation of (digest, keep) rows; one task writes one bucket, in order."""
        name = f"g{uuid.uuid4().hex}"
        table = self._table(name)
        (rows.select("digest", "keep").repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(table))
        return name

    def generations(self) -> list[DataFrame]:
        return [self.spark.table(self._table(name)) for name in self.names]

    def rows(self) -> DataFrame:
        """digest, keep of everything in the index."""
        return reduce(DataFrame.unionAll, self.generations())

    def lacking(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index lacks (planned inside ``sorted_scans``)."""
        dealt = groups.repartition(self.buckets, "digest")
        return reduce(lambda left, old: left.join(old.hint("merge"), "digest", "left_anti"), self.generations(), dealt)

    def add(self, batch: DataFrame) -> DataFrame:
        """Deduplicate a batch (doc, digest, n_points): append what is new and return
        one row for each digest of the batch: digest, keep, group_size (rows of the batch)."""
        groups = batch.groupBy("digest").agg(
            F.min_by("doc", F.struct(-F.col("n_points"), F.col("doc"))).alias("first"),
            F.count(F.lit(1)).alias("group_size"))
        groups = materialise(groups, "digest-groups")
        self._open()
        with sorted_scans(self.spark):
            new = self._write(self.lacking(groups.select("digest", F.col("first").alias("keep"))))
        self._commit([*self.names, new])
        if len(self.names) > MOST:
            self.compact()
        return groups.join(self.rows().hint("merge"), "digest").select("digest", "keep", "group_size")

    def compact(self) -> None:
        """Merge the generations into one; the files of the old ones stay for plans that still read them."""
        with sorted_scans(self.spark):
            merged = self._write(self.rows())
        self._commit([merged])

    def _commit(self, names: list[str]) -> None:
        versions.commit(self.spark, self.path, self.number + 1, {"buckets": self.buckets, "generations": names})
        self._open()

    def clean_up(self) -> list[str]:
        """Delete the generations that the last commit does not name; their names."""
        self._open()
        gone = [n for n in versions.entries(self.spark, self.path) if n.startswith("g") and n not in self.names]
        for name in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")
            versions.delete_folder(self.spark, f"{self.path}/{name}")
        return gone


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of the batch ``docs``, which is added to ``index``.

    Without one the batch meets a new, empty index below the checkpoint folder.
    """
    index = index or DigestIndex(docs.sparkSession, scratch_path(docs.sparkSession, "digest-index"))
    rows = materialise(digests(docs, id_col, text_col), "digests")
    groups = materialise(index.add(rows), "digest-verdicts")
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return rows.join(groups.hint("merge"), "digest").select(
        real("doc").alias("doc_id"), real("keep").alias("keep_id"), "group_size",
        (F.col("doc") == F.col("keep")).alias("kept"), F.col("digest").alias("text_sha256"))
