"""Connected components of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pondside.llm.common import stored


def _nearest(links: DataFrame) -> DataFrame:
    """`links` with the smallest neighbour of `u`, itself included."""
    smallest = links.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return links.join(smallest, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    near = _nearest(links)
    moved = near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """(`u`, `v`): for each linked key other than the smallest of its component, that smallest key.

    `links` has long columns `u` and `v`, in any direction. Each round writes its links as a table in the
    shared folder. The links of a round are at most those of the one before, so nothing grows; a
    key with very many links is aggregated before it is shuffled, and its join is one Spark splits.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct()
    links = stored(links, "links")
    before, now = None, _state(links)
    while now != before:
        links = stored(_small_star(_large_star(links)), "stars")
        before, now = now, _state(links)
    return links
