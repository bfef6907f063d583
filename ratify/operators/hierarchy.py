"""Reporting lines of any depth for row security.

The hierarchy table says who reports to whom, by e-mail.  A person may have
several supervisors, lines may run in a circle, and the table may name people
who report to nobody and supervisors who are consultants themselves.

Both operators join the table with itself by doubling: after round k every
line of up to 2^k steps is known, so the rounds grow with the logarithm of the
depth.  A line that comes back to a person adds no pair that is not there, so
circles end like any other line; everybody on one sees everybody on it.  Each
round is cut by a reliable checkpoint in the shared folder, and only counts
come to the driver.

Defined results: rows without a consultant's or supervisor's e-mail are no
link (the person still has a name to be seen by); rows that repeat count once;
an empty table gives no pairs and no names; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.session import ensure_checkpoint_dir


def _links(hierarchy: DataFrame) -> DataFrame:
    """manager, person: who reports to whom directly."""
    return hierarchy.select(F.col("supervisor_email").alias("manager"), F.col("consultant_email").alias("person")).where(
        "manager IS NOT NULL AND person IS NOT NULL AND manager <> person").distinct()


def _shortest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("manager", "person").agg(F.min("level").alias("level"))


def reporting_closure(hierarchy: DataFrame) -> DataFrame:
    """manager, person, level of every pair joined by a reporting line; ``level`` is the number of steps
    of the shortest one, 0 for a person and themselves.

    For tables of rights that serve all people; ``team_emails`` answers for one.
    """
    ensure_checkpoint_dir(hierarchy.sparkSession)
    links = _links(hierarchy)
    people = links.select(F.explode(F.array("manager", "person")).alias("manager")).unionByName(
        hierarchy.select(F.col("consultant_email").alias("manager")).where("manager IS NOT NULL")).distinct()
    pairs = _shortest(people.select("manager", F.col("manager").alias("person"), F.lit(0).cast("long").alias("level"))
                      .unionByName(links.withColumn("level", F.lit(1).cast("long")))).checkpoint()
    known = pairs.count()
    while True:
        below = pairs.select(F.col("manager").alias("between"), F.col("person"), F.col("level").alias("_more")).where("_more > 0")
        longer = pairs.where("level > 0").withColumnRenamed("person", "between").join(below, "between").select(
            "manager", "person", (F.col("level") + F.col("_more")).alias("level"))
        pairs = _shortest(pairs.unionByName(longer)).checkpoint()
        # all shortest lines of up to 2^k steps are known after round k; none of them is new: no longer one exists
        count = pairs.count()
        if count == known:
            return pairs
        known = count


def team_emails(hierarchy: DataFrame, email: str) -> DataFrame:
    """person: the signed-in e-mail and everybody who reports to it over any number of steps."""
    spark = hierarchy.sparkSession
    ensure_checkpoint_dir(spark)
    jumps = _links(hierarchy)
    team = spark.range(1).select(F.lit(email).cast("string").alias("person"))
    known = 1
    while True:
        # the team holds all within 2^k - 1 steps and the jumps all lines of exactly 2^k steps
        reached = jumps.join(team.withColumnRenamed("person", "manager"), "manager", "left_semi").select("person")
        team = team.unionByName(reached).distinct().checkpoint()
        count = team.count()
        if count == known:
            return team
        known = count
        twice = jumps.withColumnRenamed("person", "between").join(jumps.withColumnRenamed("manager", "between"), "between")
        jumps = twice.select("manager", "person").distinct().checkpoint()


def team_names(hierarchy: DataFrame, email: str) -> DataFrame:
    """Names of the consultants whose approvals a signed-in e-mail may see: its own and those of all below it.

    One distinct column, as ``FactOptions(approvers=...)`` takes it.
    """
    named = hierarchy.select(F.col("consultant_email").alias("person"), F.col("consultant_name").alias("_v_name"))
    return named.join(team_emails(hierarchy, email), "person", "left_semi").select("_v_name").where(
        "_v_name IS NOT NULL").distinct()
