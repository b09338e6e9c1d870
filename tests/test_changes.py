"""Changes between two states of the observations, found from those that differ."""

import pytest

from pondside.plans import merge
from pondside.plans.synthesis import synthesis_feed
from small import ROWS, small_survey


def states(spark):
    """One observation relabelled, moved, gone, new, twice in one state, and a same one that is always there twice."""
    before = [*ROWS["observations"], ("c", "uc", 1, 1001, None), ("f", "uf", 3, 1003, None)]
    now = [r for r in before if r[0] != "b"]
    now = [(*r[:4], "relu") if r[0] == "a" else r for r in now]
    now.remove(("f", "uf", 3, 1003, None))
    now += [("g", "ug", 1, 1001, None), ("n", "un", 8, 1003, None), (None, "u0", 1, 1001, None)]
    complements = [*ROWS["observation_complements"], ("g", '{"count_min":1}'), ("n", '{"count_min":1}')]
    return [small_survey(spark, observations=rows, observation_complements=complements) for rows in (before, now)]


def feeds_changes(before, now):
    """What the whole feeds of both states tell."""
    return merge.changes(*[merge.keyed(synthesis_feed(db, "mares")) for db in (before, now)])


@pytest.mark.parametrize("limits", ["db", "tight"])
def test_changed_observations_give_the_changes_of_the_feeds(spark, request, limits):
    request.getfixturevalue(limits)
    before, now = states(spark)
    found = merge.observation_changes(before, now, "mares")
    expected = feeds_changes(before, now)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.select(found.columns).collect()))
    marks = {(r["entity_source_pk_value"], r["mark"]) for r in found.collect()}
    assert marks >= {("a", "change"), ("b", "delete"), ("n", "insert")}


def test_same_observations_go_no_further(spark):
    before, now = states(spark)
    left = merge.changed_observations(before, now, "mares").collect()
    assert {r["id_observation"] for r in left} == {"a", "b", "f", "g", "n"}
    assert merge.changed_observations(now, now, "mares").count() == 0


def test_the_query_compares_observations_first(spark, capsys):
    import __spark_entry__ as entry_points

    entry_points.queries()["feed_changes"](spark, "/root/testdata/sf0.001").explain()
    lines = capsys.readouterr().out.splitlines()
    moves = [line for line in lines if " Exchange hashpartitioning(" in line and "(id_observation#" in line]
    # Both states in one move, and the complements; the feeds of both states would take four.
    assert len(moves) == 2
