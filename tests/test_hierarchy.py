"""Reporting lines of any depth (C25): against a walk in plain Python, with circles, several supervisors and gaps."""

import random

import pytest

from ratify.operators import reports
from ratify.operators.hierarchy import reporting_closure, team_emails, team_names
from ratify.plans.fact import FactOptions, fact_rows
from ratify.sources import schemas as S

from tests import fixtures as FX


def _hierarchy(spark, links, names=None):
    """Rows (person, manager) with names like the e-mails, and a column of no use."""
    rows = [(p, (names or {}).get(p, f"name {p}"), m, None, "p", 1) for p, m in links]
    return spark.createDataFrame(rows, "consultant_email string, consultant_name string, supervisor_email string, "
                                       "supervisor_name string, portfolio string, level int")


def _walk(links):
    """Shortest distance of every (manager, person), breadth first."""
    below, people = {}, set()
    for person, manager in links:
        people |= {p for p in (person,) if p is not None}
        if None not in (person, manager):
            people.add(manager)
            below.setdefault(manager, set()).add(person)
    out = {}
    for top in people:
        level, seen, edge = 0, {top}, {top}
        while edge:
            out |= {(top, p): level for p in edge}
            edge = {q for p in edge for q in below.get(p, ())} - seen
            seen |= edge
            level += 1
    return out


CHAIN = [("d", "c"), ("c", "b"), ("b", "a"), ("a", None), ("z", "y")]
CIRCLE = [("a", "c"), ("b", "a"), ("c", "b"), ("leaf", "c"), ("a", "a"), ("top's", "nobody")]
rng = random.Random(5)
TANGLE = [(f"p{rng.randrange(40)}", rng.choice([None, *(f"p{k}" for k in range(40))])) for _ in range(55)]
LONG = [(f"n{k}", f"n{k - 1}") for k in range(1, 38)]


@pytest.mark.parametrize("links", [CHAIN, CIRCLE, TANGLE, LONG, [(None, "a"), ("a", None), ("b", "a"), ("b", "a")]])
def test_closure_and_teams_equal_a_walk(spark, links):
    h = _hierarchy(spark, links)
    want = _walk(links)
    got = reporting_closure(h).collect()
    assert len(got) == len(want) and {(r.manager, r.person): r.level for r in got} == want
    for email in sorted({m for m, _ in want})[:3]:
        assert sorted(r.person for r in team_emails(h, email).collect()) == sorted(p for m, p in want if m == email)


def test_empty_table_unknown_person_and_null(spark):
    h = _hierarchy(spark, [])
    assert reporting_closure(h).count() == 0 and team_names(h, "a").count() == 0
    h = _hierarchy(spark, CHAIN, {"c": None})
    assert team_names(h, "stranger").count() == 0 and team_names(h, None).count() == 0
    # c has no name, so its approvals cannot be told; d is still seen through c
    assert sorted(r[0] for r in team_names(h, "a").collect()) == ["name a", "name b", "name d"]


def test_four_levels_see_the_rows_below_them(spark):
    t = FX.tables(spark)
    rows = fact_rows(t, None, FactOptions())
    lines = [("ana", "lead"), ("bruno", "ana"), ("lead", "head"), ("head", "chief"), ("chief", "bruno")]  # a circle, too
    h = _hierarchy(spark, [(f"{p}@x", f"{m}@x") for p, m in lines if p != "chief"],
                   {f"{p}@x": p for p, _ in lines})
    count = lambda df: {r[0]: r[1] for r in df.groupBy("_aprovador").count().collect()}
    every = count(rows)
    team = {name: n for name, n in every.items() if name in ("ana", "bruno")}
    assert team and len(team) < len(every)
    assert count(reports.visible_rows(rows, h, "chief@x")) == team
    assert count(reports.visible_rows(rows, h, "bruno@x")) == {k: n for k, n in team.items() if k == "bruno"}
    assert count(reports.visible_rows(rows, h, "chief@x", cascade=False)) == {}
    round_ = _hierarchy(spark, [(f"{p}@x", f"{m}@x") for p, m in lines], {f"{p}@x": p for p, _ in lines})
    assert count(reports.visible_rows(rows, round_, "bruno@x")) == team
    early = fact_rows(t, None, FactOptions(approvers=team_names(h, "chief@x")))
    assert count(early) == team
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    # read top down: the names meet the orders further down than the items do
    assert plan.index("_it_order") < plan.index("LeftSemi")


def test_schema_of_the_parameter_table_serves(spark):
    h = spark.createDataFrame([("a@x", "ana", "s@x", "sara", "p"), ("s@x", "sara", "h@x", "hugo", "p")], S.HIERARCHY)
    assert sorted(r[0] for r in team_names(h, "h@x").collect()) == ["ana", "sara"]
