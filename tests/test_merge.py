"""Merging the feed into a store."""

import glob
import os
from datetime import date

import pytest

from pondside import sinks
from pondside.plans import merge
from pondside.plans.synthesis import synthesis_feed
from small import ROWS, small_survey

FEED = ("a", "b", "c", "f")


@pytest.fixture
def store(spark, tmp_path):
    spark.sql(f"CREATE DATABASE store LOCATION '{tmp_path}'")
    yield "store.synthese"
    spark.sql("DROP DATABASE store CASCADE")


def files(tmp_path):
    found = glob.glob(f"{tmp_path}/synthese/**/*.parquet", recursive=True)
    return {name: os.stat(name).st_mtime_ns for name in found}


def rows(spark, store, feed):
    return sorted(map(repr, spark.table(store).select(feed.columns).collect()))


def same_as(spark, store, db):
    feed = synthesis_feed(db, "mares")
    return rows(spark, store, feed) == sorted(map(repr, feed.collect()))


def changed(spark):
    """One observation with another comment, one that is gone, a new one in another year."""
    observations = [r for r in ROWS["observations"] if r[0] != "b"]
    observations = [(*r[:4], "relu") if r[0] == "a" else r for r in observations]
    observations.append(("n", "un", 8, 1003, None))
    complements = [*ROWS["observation_complements"], ("n", '{"count_min":1}')]
    return small_survey(spark, observations=observations, observation_complements=complements)


def test_first_merge_inserts_and_the_second_writes_nothing(spark, db, store, tmp_path):
    assert merge.merge_feed(db, "mares", store) == {"insert": 4, "change": 0, "delete": 0}
    assert same_as(spark, store, db)
    before = files(tmp_path)
    assert merge.merge_feed(small_survey(spark), "mares", store) == {"insert": 0, "change": 0, "delete": 0}
    assert files(tmp_path) == before
    assert [t.name for t in spark.catalog.listTables("store")] == ["synthese"]


def test_only_touched_partitions_are_written(spark, db, store, tmp_path):
    sinks.merge_feed(db, "mares", "store")
    before = files(tmp_path)
    now = changed(spark)
    found = {(r["entity_source_pk_value"], r["mark"]) for r in merge.feed_changes(now, "mares", store).collect()}
    assert found == {("a", "change"), ("b", "delete"), ("n", "insert")}
    assert files(tmp_path) == before
    assert sinks.merge_feed(now, "mares", "store") == {"insert": 1, "change": 1, "delete": 1}
    assert same_as(spark, store, now)
    places = {tuple(r) for r in spark.table(store).where("entity_source_pk_value = 'f'").select("year", "part").collect()}
    untouched = [name for name in before if any(f"year={y}/part={p}/" in name for y, p in places)]
    after = files(tmp_path)
    others = {tuple(r) for r in spark.table(store).where("entity_source_pk_value IN ('a', 'n')").select("year", "part").collect()}
    if not places & others:
        assert untouched and all(after.get(name) == before[name] for name in untouched)


def test_partitions_without_rows_are_dropped(spark, db, store, tmp_path):
    merge.merge_feed(db, "mares", store)
    fewer = small_survey(spark, observations=[r for r in ROWS["observations"] if r[0] not in ("f", "g")])
    assert merge.merge_feed(fewer, "mares", store) == {"insert": 0, "change": 0, "delete": 1}
    assert same_as(spark, store, fewer)
    assert {r["year"] for r in spark.table(store).select("year").collect()} == {2022}
    assert not [name for name in files(tmp_path) if "year=2023" in name]


def test_a_moved_date_moves_the_row(spark, db, store):
    merge.merge_feed(db, "mares", store)
    visits = [(*r[:6], date(2024, 1, 1), r[7]) if r[0] == 3 else r for r in ROWS["visits"]]
    moved = small_survey(spark, visits=visits)
    assert merge.merge_feed(moved, "mares", store) == {"insert": 0, "change": 1, "delete": 0}
    assert same_as(spark, store, moved)


def test_another_number_of_parts_moves_rows_and_changes_none(spark, db, store):
    merge.merge_feed(db, "mares", store, parts=1)
    assert merge.merge_feed(small_survey(spark), "mares", store, parts=7) == {"insert": 0, "change": 0, "delete": 0}
    assert same_as(spark, store, db)


def test_a_broken_feed_leaves_the_store_as_it_was(spark, db, store, tmp_path):
    merge.merge_feed(db, "mares", store)
    before = files(tmp_path)
    twice = small_survey(spark, observations=[*ROWS["observations"], ROWS["observations"][0]])
    with pytest.raises(merge.BrokenKeys, match="doubled"):
        merge.merge_feed(twice, "mares", store)
    assert files(tmp_path) == before
    assert [t.name for t in spark.catalog.listTables("store")] == ["synthese"]


def test_other_sources_stay(spark, db, store):
    merge.merge_feed(db, "mares", store)
    sources = [(7, "MONITORING_MARES"), (8, "MONITORING_AUTRE")]
    visits = [(*r[:3], 3, *r[4:]) if r[0] == 3 else r for r in ROWS["visits"]]
    other = small_survey(spark, sources=sources, visits=visits)
    assert merge.merge_feed(other, "autre", store) == {"insert": 1, "change": 0, "delete": 0}
    held = {(r["id_source"], r["entity_source_pk_value"]) for r in spark.table(store).collect()}
    assert held == {(7, key) for key in FEED} | {(8, "f")}


def test_an_empty_feed_deletes_nothing(spark, db, store):
    merge.merge_feed(db, "mares", store)
    none = small_survey(spark, observations=[ROWS["observations"][4]])
    assert merge.merge_feed(none, "mares", store) == {"insert": 0, "change": 0, "delete": 0}
    assert spark.table(store).count() == 4


def test_the_comparison_joins_nothing(spark, db, capsys):
    feed = merge.keyed(synthesis_feed(db, "mares"))
    narrow = feed.select("id_source", "entity_source_pk_value", "row_hash", "year", "part").limit(3)
    capsys.readouterr()
    merge.changes(spark.createDataFrame([], narrow.schema), spark.createDataFrame([], narrow.schema)).explain()
    text = capsys.readouterr().out
    assert "Join" not in text and text.count("Exchange hashpartitioning(id_source") <= 1
