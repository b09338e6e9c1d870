"""Joins to lookups: whole results, balanced pieces, size bounds."""

import random

import pytest
from pyspark.sql import functions as F

from pondside.operators import joins


def brute_force(left, right, how):
    found = dict(right)
    return sorted(
        repr((i, key, found.get(key)))
        for i, key in left
        if how == "left" or (key is not None and key in found)
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_is_whole(spark, tight, how):
    rng = random.Random(3)
    keys = [7] * 400 + [None] * 300 + [8] * 200 + [rng.randrange(100, 200) for _ in range(300)]
    left = list(enumerate(keys))
    right = [(key, f"v{key}") for key in [7, *range(100, 190)]]
    frames = (
        spark.createDataFrame(left, "row int, k int"),
        spark.createDataFrame(right, "k int, v string"),
    )
    hot = joins.hot_keys(frames[0], "k")
    assert set(hot) == {7, 8, None}
    joined = joins.spread_join(*frames, "k", ["row"], hot, how).select("row", "k", "v")
    assert sorted(repr(tuple(row)) for row in joined.collect()) == brute_force(left, right, how)


def test_hot_rows_are_spread_over_the_tasks(spark, tight):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(20_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).alias("k")
        )
        right = spark.range(20_010).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        left = left.hint("merge")
        hot = joins.hot_keys(left, "k")
        parts = joins.spread_join(left, right, "k", ["id"], hot).where("k = 1")
        sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    # A third of the rows has one key; alone it would be one partition of 6667 rows.
    assert sum(sizes) == 6667 and len(sizes) > 8 and max(sizes) < 2500


def test_no_hot_key_in_even_or_small_data(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"))
    assert joins.hot_keys(frame, "k") == []


def test_measure_checks_rows_and_bytes(spark, monkeypatch):
    frame = spark.range(10).select("id", F.repeat(F.lit("é"), 50).alias("text"))
    assert joins.measure({"a": frame, "b": frame.limit(0)}) == {"a": True, "b": True}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 9)
    assert joins.measure({"a": frame}) == {"a": False}
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10 * (8 + 100) - 1)
    assert joins.measure({"a": frame}) == {"a": False}


def test_hot_keys_of_empty_and_null_columns(spark, tight):
    frame = spark.createDataFrame([(None, "é")] * 40 + [(5, "a")] * 60, "k bigint, s string")
    assert joins.hot_keys(frame.limit(0), "k") == []
    assert joins.hot_keys(frame, "k") == [5, None]
    assert set(joins.hot_keys(frame, "s")) == {"a", "é"}


def test_a_fact_is_never_broadcast(spark, capsys):
    left, right = spark.range(10), spark.range(3)
    joins.fact_join(left, right, "id", "left").explain()
    text = capsys.readouterr().out
    assert "SortMergeJoin" in text and "Broadcast" not in text
