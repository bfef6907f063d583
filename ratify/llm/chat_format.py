"""Chat formatting over reply trees, DataFrame functions only.

Messages (tree, id, parent, score, role, text) are forests.  Iterative
self-joins double the reach of each message's pointer: after k joins a message
knows its ancestor 2**k steps up and the sum of scores on the way, so the
depth costs a logarithmic number of joins.  Leaves are ranked in their tree
by the mean score of their branch (then length, then id).  The branches that
are chosen are enumerated by walking the same pointers down again: a segment
of up to 2**(k+1) messages splits in two, until each row is one message of
one branch.  Each branch is then formatted as one conversation.

Template of a turn: ``### Role: text</turn>`` and a line feed.  Inside roles
and texts a backslash becomes ``\\b``, ``###`` ``\\h``, ``</turn>`` ``\\e``, and
in roles a colon ``\\c``; no text can then hold a control string, and the
replacements undo in reverse order.

Defined results: null text or role is empty; a null tree or turn is a value of
its own; a parent that does not exist makes a root; messages on a cycle have
no root and belong to no branch; a message without an id belongs to no branch;
of messages with one id in a tree the least by (parent, score, role, text)
counts; rows of a conversation with equal turns follow each other by role and
text, repeated rows included; an empty table gives an empty table; other
columns are ignored.  A conversation is one row of the result, so its text must fit
one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratify.llm.common import materialise

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
# Control strings inside texts and what stands for them, in the order of escaping.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\e"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[1]), F.lit(p[0])), reversed(pairs), text)


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The nodes with depth (of a root: 0), branch score and reach, and the pointer tables.

    Table k has (tree, id, up): the ancestor 2**k steps up, where there is one.
    """
    ids = nodes.select("tree", F.col("id").alias("parent"))
    real = nodes.join(ids, ["tree", "parent"], "left_semi").where("parent <> id").select(
        "tree", "id", F.col("parent").alias("up"))
    # steps and total: of the ancestors within reach, the message itself excluded
    scores = nodes.select("tree", F.col("id").alias("up"), F.col("score").alias("total"))
    step = materialise(real.join(scores, ["tree", "up"]).withColumn("steps", F.lit(1)), "jump")
    pointers = [step.select("tree", "id", "up")]
    state = materialise(nodes.select("tree", "id", "score").join(step, ["tree", "id"], "left").select(
        "tree", "id", "up", F.coalesce("steps", F.lit(0)).alias("depth"),
        (F.col("score") + F.coalesce("total", F.lit(0.0))).alias("total")), "reach")
    levels, count = 1, nodes.count()
    while not pointers[-1].isEmpty():
        if 2 ** levels > 2 * max(count, 1):
            break  # longer than any path: what still has a pointer is on a cycle or below one
        above = state.select("tree", F.col("id").alias("up"), F.col("up").alias("far"),
                             F.col("depth").alias("more"), F.col("total").alias("more_total"))
        moving = state.where("up is not null").join(above, ["tree", "up"])
        # the ancestor's own reach starts with itself, so its score is in both sums
        own = nodes.select("tree", F.col("id").alias("up"), F.col("score").alias("own"))
        moved = moving.join(own, ["tree", "up"]).select(
            "tree", "id", F.col("far").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("more_total") - F.col("own")).alias("total"))
        state = materialise(state.where("up is null").unionByName(moved), "reach")
        pointers.append(materialise(state.where("up is not null").select("tree", "id", "up"), "jump"))
        levels += 1
    return state, pointers[:-1] if len(pointers) > 1 else pointers


def single_messages(messages: DataFrame) -> DataFrame:
    """tree, id, parent, score, role, text: one row for each id of a tree; a null tree is the tree ''."""
    row = F.struct("parent", "score", "role", "text")
    return messages.where("id is not null").groupBy(F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("tree"), "id").agg(
        F.min(row).alias("row")).select("tree", "id", "row.*")


def branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """tree, leaf, place (0: root), id, branch_rank: the messages of each chosen branch.

    ``messages`` holds one row for each (tree, id), as ``single_messages`` gives.
    ``best`` keeps so many branches of a tree (a feature); None keeps all.
    """
    nodes = materialise(messages.select("tree", "id", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias(
        "score")), "nodes")
    state, pointers = _jumps(nodes)
    parents = nodes.where("parent <> id").select("tree", F.col("parent").alias("id"))
    leaves = state.where("up is null").join(parents, ["tree", "id"], "left_anti")
    order = [(F.col("total") / (F.col("depth") + 1)).desc(), F.col("depth").desc(), "id"]
    ranked = leaves.withColumn("branch_rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
    if best is not None:
        ranked = ranked.where(F.col("branch_rank") <= best)
    rows = ranked.select("tree", F.col("id").alias("leaf"), "branch_rank", "id", (F.col("depth") + 1).cast("long").alias("span"),
                         F.col("depth").cast("long").alias("place"))
    for k in range(len(pointers) - 1, -1, -1):
        reach = 2 ** k
        far = pointers[k].select("tree", "id", "up")
        upper = rows.where(F.col("span") > reach).join(far, ["tree", "id"]).select(
            "tree", "leaf", "branch_rank", F.col("up").alias("id"), (F.col("span") - reach).alias("span"),
            (F.col("place") - reach).alias("place"))
        lower = rows.withColumn("span", F.least("span", F.lit(reach)))
        rows = materialise(lower.unionByName(upper), "branches")
    return rows.select("tree", "leaf", "place", "id", "branch_rank")


def format_branches(messages: DataFrame, best: int | None = None, learn_from: str = "assistant") -> DataFrame:
    """tree, leaf, branch_rank, formatted, loss_mask: one row for each chosen branch.

    loss_mask lists the texts that a model learns from: turn (0-based), start (code
    point in ``formatted``), offset (within the turn's block), length (escaped).
    """
    messages = single_messages(messages)
    role = escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES)
    text = escape(F.coalesce("text", F.lit("")))
    said = messages.select("tree", "id", F.concat(F.lit(HEAD), role, F.lit(MIDDLE)).alias("head"), text.alias("body"),
                           F.coalesce(F.col("role") == learn_from, F.lit(False)).alias("learn"))
    rows = branches(messages, best).join(said, ["tree", "id"])
    size = F.length("head") + F.length("body") + len(END)
    along = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("at", F.coalesce(F.sum(size).over(along), F.lit(0)).cast("long"))
    turn = F.struct("place", F.concat("head", "body", F.lit(END)).alias("block"), "learn", "at",
                    F.length("head").alias("offset"), F.length("body").alias("length"))
    turns = placed.groupBy("tree", "leaf", "branch_rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    mask = F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(
        t["place"].alias("turn"), (t["at"] + t["offset"]).alias("start"), t["offset"].alias("offset"), t["length"].alias("length")))
    return turns.select("tree", "leaf", "branch_rank", F.array_join(F.col("turns.block"), "").alias("formatted"),
                        mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with turns (array of role, text) and loss_text, both from the formatted text and its mask."""
    blocks = F.split("formatted", END, -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)
    parsed = formatted.withColumn("_blocks", blocks)
    turns = F.transform("_blocks", lambda b: F.struct(
        unescape(F.substring_index(F.substring(b, F.lit(len(HEAD) + 1), F.length(b)), MIDDLE, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(b, F.instr(b, MIDDLE) + len(MIDDLE), F.length(b))).alias("text")))
    learned = F.transform("loss_mask", lambda m: unescape(F.substring(
        F.get("_blocks", m["turn"].cast("int")), m["offset"] + 1, m["length"])))
    return parsed.withColumn("turns", turns).withColumn("loss_text", F.array_join(learned, "")).drop("_blocks")


def conversation_chains(conversations: DataFrame) -> DataFrame:
    """Messages of linear conversations: each row replies to the one before it by turn."""
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), F.coalesce("role", F.lit("")),
                                               F.coalesce("text", F.lit("")))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none")).alias("tree"),
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    number = F.row_number().over(order).cast("long")
    return rows.withColumn("id", number).withColumn("parent", F.col("id") - 1).withColumn("score", F.lit(0.0))


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold control strings."""
    text = "\\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                 "conv_id long, turn long, role string, text string")


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Format every conversation (and the probe) and describe what reads back."""
    spark = conversations.sparkSession
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(probe(spark))
    messages = materialise(conversation_chains(rows), "chains")
    back = read_back(format_branches(messages))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.when(F.col("tree") != "none", F.substring("tree", 2, 40).cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
