"""Sinks: temp view (S2), table replace (S3), view (S4), monthly refresh.

The fact is written partitioned by approval month.  A full replace drops every
old month; a refresh rewrites the months that its weeks touch and removes
those that have no rows any more.  Into a ``VersionedTable`` either is one
commit; into a plain folder or catalog table it is a static or dynamic
overwrite, of which a failure can show a part.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratify.operators.changes import month_ranges
from ratify.plans.fact import FactOptions, RuleTables, approval_fact, stage_folder
from ratify.sources.catalog import Tables
from ratify.sources.versions import MONTH_COL, VersionedTable, delete_folder, month_folders


def register_temp_view(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped named plan (nothing is materialised)."""
    df.createOrReplaceTempView(name)
    return df


def create_or_replace_view(df: DataFrame, name: str, global_view: bool = False) -> str:
    """A named view over the lazy plan; global views are visible to every
    session of the application (``global_temp.<name>``)."""
    if global_view:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name


def with_month(df: DataFrame, date_col: str = "data_aprovacao") -> DataFrame:
    d = F.col(date_col)
    return df.withColumn(MONTH_COL, (F.year(d) * 100 + F.month(d)).cast("int"))


def replace_table(df: DataFrame, name: str | None = None, path: str | VersionedTable | None = None,
                  partition_by: str | None = MONTH_COL, sort_within: list[str] | None = None,
                  fmt: str = "parquet") -> None:
    """S3: full replace of a table (catalog name or path), partitioned by month.

    ``sort_within`` clusters the output like the table form's final ORDER BY:
    a range shuffle on (month, keys) — sampled boundaries split a busy month
    over many tasks instead of sending it to one — then a sort inside each
    task, so every file holds a sorted key range.  A ``VersionedTable`` as
    ``path`` is replaced by one commit, by its own month column.
    """
    if partition_by and partition_by not in df.columns:
        df = with_month(df)
    if isinstance(path, VersionedTable):
        if name or fmt != "parquet" or partition_by != path.column:
            raise ValueError("a versioned table has a path, Parquet files and its own month column")
        path.replace(df, sort_within)
        return
    if sort_within:
        cols = ([partition_by] if partition_by else []) + list(sort_within)
        df = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    if name:
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    else:
        w.save(path)


def create_stored_view(spark: SparkSession, name: str, sql: str) -> str:
    """A view in the catalog that outlives the session; ``sql`` reads catalog tables."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return name


def touched_from(since: dt.date) -> tuple[dt.date, int]:
    """First day to compute and first month to write when days from ``since`` on changed.

    The totals of since's week change for all its days, so its Monday's month
    is written; that month's first week may begin in the month before.
    """
    monday = since - dt.timedelta(days=since.weekday())
    month = monday.replace(day=1)
    return month - dt.timedelta(days=month.weekday()), monday.year * 100 + monday.month


def held_months(spark: SparkSession, target: str | VersionedTable) -> list[int]:
    """The months that a stored fact has."""
    return target.months() if isinstance(target, VersionedTable) else sorted(month_folders(spark, target))


def read_fact(spark: SparkSession, target: str | VersionedTable) -> DataFrame:
    """A stored fact, plain or versioned."""
    return target.read() if isinstance(target, VersionedTable) else spark.read.parquet(target)


def refresh_fact(spark: SparkSession, tables: Tables, path: str | VersionedTable, opts: FactOptions,
                 rules: RuleTables | None = None, since: dt.date | None = None) -> list[int]:
    """Recompute the fact (all of it, or what ``since`` touches) and rewrite those
    months, so that the table equals a full rebuild.  Returns the months that it holds
    in that range afterwards; months without rows any more are removed.

    A run that fails is simply run again; a versioned table shows nothing of it.
    """
    run_opts, first_month = opts, 0
    if since is not None:
        start, first_month = touched_from(since)
        run_opts = replace(opts, start_date=max(start.isoformat(), opts.start_date))
    return _rewrite_months(spark, tables, path, run_opts, rules, F.col(MONTH_COL) >= first_month,
                           lambda month: month >= first_month)


def refresh_months(spark: SparkSession, tables: Tables, path: str | VersionedTable, opts: FactOptions,
                   months: set[int], rules: RuleTables | None = None) -> list[int]:
    """Recompute exactly ``months`` (yyyymm) and rewrite them; the files of other months stay as they are.

    The weekly totals need whole weeks, so the days of the weeks that a month
    takes part in are read, and no others.
    """
    if not months:
        return []
    return _rewrite_months(spark, tables, path, replace(opts, days=month_ranges(months)), rules,
                           F.col(MONTH_COL).isin(sorted(months)), months.__contains__)


def _rewrite_months(spark: SparkSession, tables: Tables, path: str | VersionedTable, opts: FactOptions,
                    rules: RuleTables | None, kept: Column, concerns) -> list[int]:
    """Compute the fact, overwrite those of its months that are ``kept`` and remove other months that it
    ``concerns``; the months it has.

    The rows before the weekly totals are staged in the shared checkpoint folder:
    the sources are read once for rows and totals, and what is written to the
    target depends on the staged rows alone, never on the target.  A versioned
    table takes the months as one commit.
    """
    stage = stage_folder(spark)
    fact = with_month(approval_fact(tables, rules, replace(opts, staged=stage), spark=spark)).filter(kept)
    if isinstance(path, VersionedTable):
        made = path.rewrite(fact, concerns)
    else:
        made = sorted(r[0] for r in fact.select(MONTH_COL).distinct().collect())  # one row a month
        if made:
            fact.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_COL).parquet(path)
        for month, folder in month_folders(spark, path).items():
            if concerns(month) and month not in made:
                delete_folder(spark, folder)
    delete_folder(spark, stage)
    return made
