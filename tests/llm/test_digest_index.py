"""The digest index: opened again by its path, read in its stored order, compacted, safe against half a batch."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ratify.llm import exact_dedup
from ratify.llm.exact_dedup import DigestIndex, digests, sorted_scans
from ratify.sources import versions

SCHEMA = "doc_id long, text string"


def _path():
    return f"{tempfile.mkdtemp(prefix='ratify-digests-')}/index"


def _keeps(df):
    return {(r.doc_id, r.keep_id) for r in df.collect()}


def _first(spark):
    return spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], SCHEMA)


def _second(spark):
    return spark.createDataFrame([(4, "a  b  "), (5, "d"), (6, "d")], SCHEMA)


def test_a_second_session_opens_the_index(spark):
    path = _path()
    assert _keeps(exact_dedup.exact_dedup(_first(spark), DigestIndex(spark, path, 4))) == {(1, 1), (2, 1), (3, 3)}
    for table in spark.catalog.listTables():
        if table.name.startswith("digest_index_"):  # the catalog of the other session knows none of these
            spark.sql(f"DROP TABLE {table.name}")
    index = DigestIndex(spark.newSession(), path, 16)
    assert index.buckets == 4 and index.rows().count() == 2
    assert _keeps(exact_dedup.exact_dedup(_second(index.spark), index)) == {(4, 1), (5, 5), (6, 5)}
    assert DigestIndex(spark, path).rows().count() == 3


def test_the_index_side_is_neither_shuffled_nor_sorted(spark):
    index = DigestIndex(spark, _path(), 4)
    exact_dedup.exact_dedup(_first(spark), index)
    exact_dedup.exact_dedup(_second(spark), index)
    assert len(index.names) == 3
    batch = digests(spark.createDataFrame([(i, f"t{i}") for i in range(50)], SCHEMA)).selectExpr("digest", "doc AS keep")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with sorted_scans(spark):
            plan = index.lacking(batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") == plan.count("LeftAnti") == 3
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1  # those of the batch


def test_many_batches_equal_one_pass_and_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MOST", 3)
    index, rng, first, got = DigestIndex(spark, _path(), 3), random.Random(3), {}, set()
    for n in range(5):
        rows = [(100 * n + i, rng.choice([None, "", " x", "x", "yy", f"z{rng.randrange(40)}"])) for i in range(30)]
        batch = {}
        for doc, text in rows:
            batch.setdefault((text or "").replace(" ", ""), []).append((-len(text or ""), doc))
        for key, own in batch.items():
            first.setdefault(key, min(own)[1])
        want = {(doc, first[(text or "").replace(" ", "")]) for doc, text in rows}
        assert _keeps(exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), index)) == want
        got |= want
        assert len(index.names) <= 3
    assert index.rows().count() == len(first) == index.rows().distinct().count()
    files = index.rows().select(F.input_file_name().alias("f")).distinct().count()
    assert files <= index.buckets * len(index.names)  # one file a bucket, after a merge, too
    assert index.clean_up() and index.clean_up() == [] and index.rows().count() == len(first)


def test_half_a_batch_adds_nothing(spark, monkeypatch):
    path = _path()
    index = DigestIndex(spark, path, 2)
    exact_dedup.exact_dedup(_first(spark), index)
    monkeypatch.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        exact_dedup.exact_dedup(_second(spark), index)
    monkeypatch.undo()
    again = DigestIndex(spark, path)
    assert again.rows().count() == 2
    assert _keeps(exact_dedup.exact_dedup(_second(spark), again)) == {(4, 1), (5, 5), (6, 5)}


def test_empty_and_very_long_texts(spark):
    index = DigestIndex(spark, _path(), 2)
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA), index).count() == 0
    long = "word " * 400_000
    rows = [(1, long), (2, long.replace(" ", "")), (None, ""), (3, None), (3, None)]
    assert _keeps(exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), index)) == {(1, 1), (2, 1), (None, 3), (3, 3)}
