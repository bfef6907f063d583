"""The line index: opened again by its path, read in its stored order, levelled, safe against half a batch."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ratify.llm import line_dedup
from ratify.llm.common import sorted_scans
from ratify.llm.line_dedup import LineIndex
from ratify.sources import versions

SCHEMA = "doc long, key binary"


def _path():
    return f"{tempfile.mkdtemp(prefix='ratify-lines-')}/index"


def _owners(index):
    return {(bytes(r.key), r.owner) for r in index.owners().collect()}


def _batch(spark, *rows):
    return spark.createDataFrame([(doc, key.encode()) for doc, key in rows], SCHEMA)


def test_a_second_session_opens_the_index(spark):
    path = _path()
    LineIndex(spark, path, 3, 4).add(_batch(spark, (1, "a"), (2, "a"), (2, "b")))
    for table in spark.catalog.listTables():
        if table.name.startswith("line_index_"):  # the catalog of the other session knows none of these
            spark.sql(f"DROP TABLE {table.name}")
    other = spark.newSession()
    index = LineIndex(other, path, 9, 16)
    assert (index.buckets, index.fanout) == (4, 3) and _owners(index) == {(b"a", 1), (b"b", 2)}
    index.add(_batch(other, (3, "b"), (3, "c")))
    assert _owners(LineIndex(spark, path)) == {(b"a", 1), (b"b", 2), (b"c", 3)}


def test_the_runs_are_neither_shuffled_nor_sorted(spark):
    index = LineIndex(spark, _path(), 8, 4)
    for n in range(3):
        index.add(_batch(spark, *[(n, f"k{n}{i}") for i in range(20)]))
    fresh = _batch(spark, *[(9, f"k{i}") for i in range(50)]).selectExpr("key", "doc AS owner")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with sorted_scans(spark):
            plan = index.lacking(fresh)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") == plan.count("LeftAnti") == 3
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1  # those of the batch


def test_many_batches_equal_one_pass_in_levels(spark):
    index, rng, want = LineIndex(spark, _path(), 2, 3), random.Random(5), {}
    for n in range(7):
        rows = [(100 * n + i, f"key {rng.randrange(60)}") for i in range(30)]
        for doc, key in rows:
            want.setdefault(key.encode(), doc)
        index.add(_batch(spark, *rows))
    assert [len(level) for level in index.levels] == [1, 1, 1]  # 7 batches, in twos
    assert _owners(index) == set(want.items()) and index.owners().count() == len(want)
    files = index.owners().select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 3 * 3                                       # one file a bucket and run
    assert index.clean_up() and index.clean_up() == [] and _owners(index) == set(want.items())


def test_half_a_batch_adds_nothing(spark, monkeypatch):
    path = _path()
    index = LineIndex(spark, path, 4, 2)
    index.add(_batch(spark, (1, "a")))
    monkeypatch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        index.add(_batch(spark, (2, "b")))
    monkeypatch.undo()
    again = LineIndex(spark, path)
    assert _owners(again) == {(b"a", 1)}
    again.add(_batch(spark, (2, "b")))
    assert _owners(again) == {(b"a", 1), (b"b", 2)}


def test_an_empty_index_and_empty_batches(spark):
    index = LineIndex(spark, _path(), 2, 2)
    assert index.owners().count() == 0 and index.owners().columns == ["key", "owner"]
    for _ in range(3):
        index.add(_batch(spark, (1, "a")).limit(0))
    assert index.owners().count() == 0


def test_a_very_long_text_and_a_hot_line(spark):
    hot, long = "the line that every row holds", "\n".join(f"line number {i} of many" for i in range(100_000))
    docs = spark.createDataFrame([(i, hot) for i in range(40)] + [(50, f"{long}\n{hot}"), (51, long)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.line_figures(docs).collect()}
    assert got == {0: (1, 0)} | {i: (1, 1) for i in range(1, 40)} | {50: (100_001, 1), 51: (100_000, 100_000)}
