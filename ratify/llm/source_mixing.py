"""Mixing sources to target weights by entropy balancing.

Every source gets a token target.  Document rates are the exponential tilt
exp(lambda of the source) that meets the targets while staying closest (in
relative entropy over tokens) to taking each document once; the multipliers
solve the convex dual, sum of tokens * exp(lambda) - lambda * target, by
Newton steps, each one aggregate over the sources' token counts.  Rates become
copies: everybody gets the whole part; the fraction goes to documents in hash
order until the source's tokens are used up, and documents are passed over
that no longer fit, so the rest is smaller than what any document left out
holds.  Only the bins of hashes in which the room runs short are looked at row
by row: after each, the bins that follow are counted again with the room that
is left and the documents that still fit.  Where the rest is over
``REST_SHARE`` of the target all the same (only long documents are left out),
the source is filled again, heavy documents first, and the smaller rest counts.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share
all tokens; none gets more than ``most`` times its own, the excess goes to the
others by weight.

Defined results: null text has size 0 and is taken with 0 words; a null
source is a source; rows that repeat (source, id, size) get the same copies;
a source without tokens has target 0; an empty table gives an empty table;
other columns are ignored by ``mixing`` and pass through ``mixed_documents``.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratify.llm.common import NO_ID, SPACES, id_key, materialise, ship

# Fixed values of the targets.
WEIGHTS = (1, 2, 3)
MOST = 3

#: Rows of a source that one bin of hashes holds about, and the most bins of a source and rank.
BIN_ROWS, MOST_BINS = 256, 1 << 16

#: A rest over this share of the target is filled again, documents over this share of the room first, by halves.
REST_SHARE = 1 / 1024

#: Room that is only rounding.
NO_ROOM = 1e-6


def source_key(column: str = "source") -> Column:
    """The source as a key without nulls that sorts by code point, null last."""
    text = F.col(column).cast("string")
    return F.when(text.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), text))


def word_count(text_col: str = "text") -> Column:
    """Runs of characters other than white space: each becomes one mark, then the blanks go."""
    marks = F.regexp_replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(functools.reduce(lambda t, space: F.replace(t, F.lit(space), F.lit("")), SPACES, marks)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc, source, size of every row."""
    return docs.select(id_key(id_col).alias("doc"), source_key(source_col).alias("source"), word_count(text_col).alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target for (source, source_size): the shares with the cap.

    Sources whose cap is small for their weight are full first.  In that
    order, all up to the k-th are full if what is left to the others, by
    weight, would give the k-th more than its cap.  One row for each source.
    """
    order = Window.orderBy("source")
    ranked = totals.withColumn("place", F.row_number().over(order) - 1)
    chosen = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", chosen.cast("long")).withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = caps.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    full = level.withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
    # the level for the sources that are not full is the first such source's
    share = full.withColumn("share", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "source", "level")))
                            .over(everything)["level"])
    return share.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("share")).alias("target"))


def newton_rates(wanted: DataFrame, tolerance: float = 1e-12, most_steps: int = 60) -> DataFrame:
    """``wanted`` (source, source_size, target) with rate = exp(lambda) of the dual's optimum.

    The dual is a sum over sources, so its Hessian is diagonal: a step is
    lambda + (target - moment) / moment with moment = source_size * exp(lambda),
    held to one at most.  Iterates until every gradient is within
    ``tolerance`` of its target; sources without tokens or target have rate 0.
    """
    state = wanted.withColumn("lambda", F.lit(0.0))
    moment = F.col("source_size") * F.exp("lambda")
    for _ in range(most_steps):
        step = F.least(F.lit(1.0), (F.col("target") - moment) / moment)
        state = state.withColumn("lambda", F.when(F.col("target") > 0, F.col("lambda") + step).otherwise(F.col("lambda")))
        state = materialise(state, "mix-dual")
        worst = state.where(F.col("target") > 0).agg(F.max(F.abs(moment / F.col("target") - 1))).first()[0]
        if worst is None or worst <= tolerance:
            break
    return state.withColumn("rate", F.when(F.col("target") > 0, F.exp("lambda")).otherwise(F.lit(0.0)))


def _fill(units: pd.DataFrame) -> pd.DataFrame:
    """A bin in which a source's room runs short: take what fits, heavy ranks by weight, the others in hash order."""
    by_weight = units["weight"].where(units["rank"] > 0, 0)
    units = units.assign(by_weight=-by_weight).sort_values(["by_weight", "place", "doc", "size"], kind="stable")
    left, taken = float(units["room"].iloc[0]), []
    for weight in units["weight"].tolist():
        taken.append(weight <= left)
        left -= weight if taken[-1] else 0
    return units[["source", "doc", "size"]].assign(taken=taken, left=left)


def _binned(units: DataFrame, plan: DataFrame, rank: Column) -> DataFrame:
    """``units`` of the sources of ``plan`` with rank and ``at``, the bin in the order of filling: high ranks
    first, hash order in a rank."""
    ranked = units.join(plan, "source").withColumn("rank", rank.cast("long"))
    bins = materialise(ranked.groupBy("source", "rank").agg(
        F.greatest(F.lit(1), F.least(F.lit(MOST_BINS), F.ceil(F.count(F.lit(1)) / BIN_ROWS))).alias("bins")), "mix-bins")
    return ranked.join(bins, ["source", "rank"]).withColumn(
        "at", F.floor(F.col("place") * F.col("bins")) - F.col("rank") * MOST_BINS).drop("bins")


def _filled(units: DataFrame, plan: DataFrame, rank: Column) -> tuple[DataFrame, DataFrame]:
    """(source, doc, size) of the units that fit one after the other, and (source, left) of ``plan``.

    Each round takes the whole bins up to the one that the room does not hold,
    fills that one row by row, and goes on behind it.  Its documents that do
    not fit are heavier than the new room, so rounds get fewer documents.
    Empty documents are not for filling: behind the first such bin none is taken.
    """
    placed = _binned(units, plan, rank)
    room = plan.select("source", F.lit(-(2**62)).alias("last"), F.col("wanted").alias("room")).where(F.col("room") > NO_ROOM)
    rooms, parts = [plan.select("source", F.col("wanted").alias("left"), F.lit(0).alias("round"))], []
    while not room.isEmpty():
        fits = (F.col("weight") <= F.col("room")) & ((F.col("weight") > 0) | F.lit(not parts))
        still = placed.join(room, "source").where((F.col("at") > F.col("last")) & fits)
        histogram = still.groupBy("source", "at").agg(F.sum("weight").alias("tokens"), F.first("room").alias("room"))
        so_far = F.sum("tokens").over(Window.partitionBy("source").orderBy("at"))
        short = F.col("so_far") > F.col("room")
        ends = materialise(histogram.withColumn("so_far", so_far).groupBy("source").agg(
            F.min(F.when(short, F.struct("at", (F.col("room") - F.col("so_far") + F.col("tokens")).alias("room")))).alias("edge"),
            (F.first("room") - F.max("so_far")).alias("rest")), "mix-ends")
        edges = ends.where(F.col("edge").isNotNull()).select(
            "source", F.col("edge.at").alias("edge_at"), F.col("edge.room").alias("edge_room"))
        edge = still.join(edges, "source").where(F.col("at") == F.col("edge_at")).select(
            "source", "doc", "size", "weight", "rank", "place", F.col("edge_room").alias("room"))
        ship(units.sparkSession)
        row_by_row = materialise(edge.groupBy("source").applyInPandas(
            _fill, "source string, doc long, size long, taken boolean, left double"), "mix-filled")
        parts.append(still.join(edges, "source", "left").where(
            F.col("edge_at").isNull() | (F.col("at") < F.col("edge_at"))).select("source", "doc", "size"))
        parts.append(row_by_row.where("taken").select("source", "doc", "size"))
        lefts = row_by_row.groupBy("source").agg(F.first("left").alias("left"))
        rooms.append(ends.where(F.col("edge").isNull()).select("source", F.col("rest").alias("left"))
                     .unionByName(lefts).withColumn("round", F.lit(len(rooms))))
        room = materialise(edges.join(lefts, "source").select("source", F.col("edge_at").alias("last"), F.col("left").alias("room"))
                           .where(F.col("room") >= 1), "mix-room")
    none = units.select("source", "doc", "size").limit(0)
    left = functools.reduce(DataFrame.unionByName, rooms).groupBy("source").agg(F.max_by("left", "round").alias("left"))
    return functools.reduce(DataFrame.unionByName, parts, none), materialise(left, "mix-left")


def copies(rows: DataFrame, rated: DataFrame) -> DataFrame:
    """source, doc, size, source_size, target, copies: one row for each distinct (source, doc, size)."""
    spread = (F.xxhash64("source", "doc", "size").bitwiseAND(2**53 - 1) / float(2**53)).alias("place")
    units = materialise(rows.groupBy("source", "doc", "size").agg(
        (F.col("size") * F.count(F.lit(1))).alias("weight")).select("*", spread), "mix-units")
    plan = materialise(rated.select("source", "source_size", "target", F.floor(F.col("rate") + 1e-9).alias("whole")).withColumn(
        "wanted", F.col("target") - F.col("whole") * F.col("source_size")), "mix-plan")
    wanted = plan.select("source", "target", "wanted")
    taken, left = _filled(units, wanted, F.lit(0))
    again = materialise(wanted.join(left, "source").where(F.col("left") > F.col("target") * REST_SHARE), "mix-again")
    if not again.isEmpty():
        # halves of the room: one over REST_SHARE is rank 1, and so on
        rank = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("weight"), F.lit(1)) / (F.col("wanted") * REST_SHARE))))
        retaken, releft = _filled(units, again.drop("left"), rank)
        better = materialise(releft.join(again.select("source", F.col("left").alias("before")), "source").where(
            F.col("left") < F.col("before")).select("source", "left"), "mix-better")
        taken = taken.join(better, "source", "left_anti").unionByName(retaken.join(better.select("source"), "source"))
        left = left.join(better, "source", "left_anti").unionByName(better)
    granted = materialise(units.join(taken.withColumn("extra", F.lit(1)), ["source", "doc", "size"], "left").withColumn(
        "extra", F.coalesce("extra", F.lit(0))), "mix-granted")
    # the one document more that brings the sum nearer to what is wanted
    nearest = granted.where("extra = 0").join(left, "source").where(
        (F.col("weight") > 0) & (F.col("weight") < 2 * F.col("left"))).groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("weight") - F.col("left")).alias("off"), "place", "doc", "size")).alias("one"))
    nearest = materialise(nearest.select("source", "one.doc", "one.size", F.lit(1).alias("one_more")), "mix-nearest")
    return granted.join(plan, "source").join(nearest, ["source", "doc", "size"], "left").select(
        "source", "doc", "size", "source_size", "target",
        (F.col("whole") + F.col("extra") + F.coalesce("one_more", F.lit(0))).cast("long").alias("copies"))


def _decided(docs: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    rows = materialise(sizes(docs), "mix-sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rated = newton_rates(materialise(targets(totals, weights, most), "mix-targets"))
    return rows, copies(rows, rated)


def mixing(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row."""
    rows, decided = _decided(docs, weights, most)
    return rows.join(decided, ["source", "doc", "size"]).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each document as often as its copies say."""
    _, decided = _decided(docs, weights, most)
    keyed = docs.select(id_key().alias("doc"), source_key().alias("source"), word_count().alias("size"),
                        F.struct(*docs.columns).alias("row"))
    taken = keyed.join(decided.where("copies > 0").select("source", "doc", "size", "copies"), ["source", "doc", "size"])
    repeated = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select("row.*")
