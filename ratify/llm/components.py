"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratify.llm.common import drop_scratch, materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def join_totals(rows: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns that ``totals``, an aggregate by ``key``, has for them.

    Joined on another form of the key, so that both sides meet in exchanges of
    the join itself: of these Spark broadcasts a small one or splits a hot key,
    which it does not where an aggregate stands right below a join.
    """
    other = F.col(key).bitwiseXOR(F.lit(1))
    return rows.withColumn("_key", other).join(totals.withColumn("_key", other).drop(key), "_key").drop("_key")


def large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return join_totals(near, least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_totals(down, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """node, component (its least node) for each node of ``edges`` (u, v, longs).

    Rounds run until the edges are stars: large-star leaves them as they are and
    no node has two smaller neighbours.  Every step is written to the shared folder with its number of edges and an
    order-free digest, so a lost executor costs one step at most.  Rows with a
    null end or u = v are left out.
    """
    state, mark = _written(edges.where("u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        large, after = _written(large_star(state), "large-stars")
        drop_scratch(state)
        if after == mark and large.select("u").distinct().count() == mark[0]:
            state = large
            break
        state, mark = _written(small_star(large), "stars")
        drop_scratch(large)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    hubs = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return hubs.unionByName(state.select(F.col("u").alias("node"), F.col("v").alias("component")))


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges written, and their number and digest as the write has seen them."""
    seen = Observation()
    table = materialise(edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("two")), name)
    return table, tuple(seen.get.values())


def contracted(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """``found`` (node, component) after more ``links`` (u, v): only links between two components count,
    and the rounds run on components instead of nodes."""
    if found is None:
        return materialise(connected_components(links), "components")
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
    ends = links.join(of("u"), "u", "left").join(of("v"), "v", "left").select(
        F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")).where("u <> v")
    merged = materialise(connected_components(ends).select(F.col("node").alias("component"), F.col("component").alias("into")), "merged")
    moved = found.join(merged, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    fresh = merged.select(F.col("component").alias("node"), F.col("into").alias("component")).join(found, "node", "left_anti")
    return materialise(moved.unionByName(fresh), "components")
