"""Tables that change by one commit.

Below a table's folder lie data folders, never changed once they are written,
and numbered commit files in ``_commits``.  The commit with the highest number
says which data folders count, by month, and with what schema.  A writer first
writes a data folder of its own, then adds the next commit by a rename that
fails if that number is there already.  So a write that fails half-way leaves
readers on the commit before, a replace or refresh of any number of months
(emptied ones included) shows at once, and of two writers that began from the
same commit the second one is refused (``CommitConflict``) and is run again.

A DataFrame read from a commit keeps reading that commit's folders;
``clean_up`` deletes what the last commits do not name, so it is run when no
reader or writer of older ones is left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH_COL = "approval_month"
COMMITS = "_commits"


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _hadoop(spark, path)
    fs.delete(folder, True)


def entries(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and paths of what lies in a folder; nothing if it does not exist."""
    folder, fs = _hadoop(spark, path)
    if not fs.exists(folder):
        return {}
    return {e.getPath().getName(): e.getPath().toString() for e in fs.listStatus(folder)}


def month_folders(spark: SparkSession, path: str, column: str = MONTH_COL) -> dict[int, str]:
    """Months that a table folder holds, by its partition folders."""
    named = {name.partition("="): folder for name, folder in entries(spark, path).items()}
    return {int(value): folder for (label, _, value), folder in named.items() if label == column and value.isdigit()}


def commits(spark: SparkSession, path: str) -> dict[int, str]:
    """Numbers and files of the commits."""
    found = entries(spark, f"{path}/{COMMITS}")
    return {int(name[:-5]): file for name, file in found.items() if name.endswith(".json") and name[:-5].isdigit()}


def newest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the last commit; (0, {}) without any."""
    found = commits(spark, path)
    return (max(found), read_commit(spark, found[max(found)])) if found else (0, {})


def read_commit(spark: SparkSession, file: str) -> dict:
    # the whole file as one row: its length is that of one entry a month
    return json.loads(spark.read.text(file, wholetext=True).first()[0])


def commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Add commit ``number``; refused if it exists."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft, fs = _hadoop(spark, f"{path}/{COMMITS}/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/{number:08d}.json")
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(draft, final, no_options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise CommitConflict(f"{path}: commit {number} is there already") from error
        raise


class VersionedTable:
    """A table partitioned by month below ``path``, without its months where it holds no commit yet."""

    def __init__(self, spark: SparkSession, path: str, column: str = MONTH_COL):
        self.spark, self.path, self.column = spark, path.rstrip("/"), column

    def __str__(self) -> str:
        return self.path

    def months(self) -> list[int]:
        return sorted(int(month) for month in newest(self.spark, self.path)[1].get("months", {}))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the last commit, or of commit ``number``."""
        if number is None:
            content = newest(self.spark, self.path)[1]
        else:
            content = read_commit(self.spark, commits(self.spark, self.path)[number])
        if not content:
            raise ValueError(f"{self.path} holds no commit")
        schema = T.StructType.fromJson(content["schema"])
        by_write: dict[str, list[str]] = {}
        for month, write in sorted(content["months"].items()):
            by_write.setdefault(write, []).append(f"{self.path}/{write}/{self.column}={month}")
        if not by_write:
            return self.spark.createDataFrame([], schema)
        # a write is a table folder of its own; filters on the month prune the folders of each
        return reduce(DataFrame.unionAll, [
            self.spark.read.schema(schema).option("basePath", f"{self.path}/{write}").parquet(*folders)
            for write, folders in by_write.items()]).select(*schema.names)

    def replace(self, df: DataFrame, sort_within: list[str] | None = None) -> list[int]:
        """S3: ``df`` in place of all rows, as one commit; the months it has."""
        return self.rewrite(df, lambda month: True, sort_within)

    def rewrite(self, df: DataFrame, concerns: Callable[[int], bool], sort_within: list[str] | None = None) -> list[int]:
        """``df`` in place of the months that it has or ``concerns``, as one commit; the months that ``df`` has.

        Other months keep their files.  ``sort_within`` as in ``sinks.replace_table``.
        """
        number, content = newest(self.spark, self.path)
        held = content.get("months", {})
        if sort_within:
            cols = [self.column, *sort_within]
            df = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
        names = [c for c in df.columns if c != self.column]
        schema = df.select(*names, F.col(self.column).cast("int").alias(self.column)).schema
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        if any(not concerns(int(m)) for m in held) and T.StructType.fromJson(content["schema"]) != schema:
            raise ValueError(f"{self.path}: the columns differ from those of the months that stay")
        write = f"data-{uuid.uuid4().hex}"
        df.write.partitionBy(self.column).parquet(f"{self.path}/{write}")
        if f"{self.column}=__HIVE_DEFAULT_PARTITION__" in entries(self.spark, f"{self.path}/{write}"):
            raise ValueError(f"{self.path}: rows without {self.column}")
        made = sorted(month_folders(self.spark, f"{self.path}/{write}", self.column))
        months = {m: folder for m, folder in held.items() if not concerns(int(m)) and int(m) not in made}
        commit(self.spark, self.path, number + 1,
               {"schema": schema.jsonValue(), "months": months | {str(m): write for m in made}})
        return made

    def clean_up(self, keep: int = 2) -> list[str]:
        """Delete the data folders that none of the last ``keep`` commits names, and the commits before;
        the names of the deleted data folders."""
        if keep < 1:
            raise ValueError("the last commit has to stay")
        found = commits(self.spark, self.path)
        stay = sorted(found)[-keep:]
        used = {write for n in stay for write in read_commit(self.spark, found[n])["months"].values()}
        for number in sorted(set(found) - set(stay)):
            delete_folder(self.spark, found[number])
        gone = [name for name in entries(self.spark, self.path) if name.startswith("data-") and name not in used]
        for name in gone:
            delete_folder(self.spark, f"{self.path}/{name}")
        return gone
