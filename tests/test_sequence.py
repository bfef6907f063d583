"""LEAD by buckets equals the plain window, also when one key holds most rows."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratify.operators.sequence import next_in_group


def _plain(df):
    w = Window.partitionBy("k").orderBy("t", "u")
    return df.select("k", "t", "u", F.lead("t").over(w).alias("next_t"),
                     F.lead("u").over(w).alias("next_u"))


def _rows(df):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    return sorted((tuple(r) for r in df.select("k", "t", "u", "next_t", "next_u").collect()), key=key)


def test_hot_key_matches_plain_window(spark):
    # key 0 holds ~2/3 of the rows, with many ties on t; a NULL key, NULL times, and empty buckets
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 2, F.col("id") % 50).otherwise(F.lit(0)).cast("long").alias("k"),
        (F.col("id") % 700 * 3).alias("t"), (F.col("id") % 7).alias("u"))
    df = df.union(spark.createDataFrame([(None, 5, 1), (None, 3, 2), (0, None, 1), (7, None, 1)],
                                        "k long, t long, u long"))
    got = next_in_group(df, ["k"], ["t", "u"], ["t", "u"], F.floor(F.col("t") / 100))
    assert _rows(got) == _rows(_plain(df))


def test_window_is_split_by_bucket(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id").alias("t"), F.lit(0).alias("u"))
    got = next_in_group(df, ["k"], ["t"], ["t"], F.floor(F.col("t") / 10))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_sq_bucket" in plan
    rows = sorted((r.t, r.next_t) for r in got.collect())
    assert rows[:2] == [(0, 1), (1, 2)] and rows[-1] == (199, None)


def test_driver_change_log(spark):
    from ratify.operators.changelog import membership_changes, membership_events, order_events
    from ratify.sources.analog import analog_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(f"{sf}/orders.parquet"):
        return
    ev = membership_events(membership_changes(analog_tables(spark, sf, with_calendar=False).param_log))
    w = Window.partitionBy("CodigoCliente", "approver").orderBy("ts", F.when(F.col("event_type") == "ADD", 1).otherwise(0))
    plain = ev.select("*", F.lead("ts").over(w).alias("next_ts"), F.lead("event_type").over(w).alias("next_event_type"))
    got = order_events(ev).select(*plain.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
