"""Mixing sources to target weights: blocks of words dealt out by highest quotients.

Sainte-Laguë gives every source a whole number of words, and within a source every shard; a source at its limit gets
exactly that. The words are taken in blocks of which the last may be short, so that no source is too small for one. The
documents of a shard lie on a ring in seeded order, cut into blocks of `block` words. A quota over the
ring's length takes all of it once or twice; the rest is the run of blocks from a seeded one on. As the
order is seeded too, that run is a random choice of documents.

Defined results: NULL or blank texts have size 0 and nothing is taken of them; NULL is a source of its
own, the last; equal rows are told apart by their place on the ring only, so the rows returned do not
depend on it; an empty table gives no rows. Other columns are carried along untouched, whatever they are
called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import stored, words_of

BLOCK = 16
SHARD_WORDS = 50_000
MOST_SHARDS = 4096
# Up to so many sources, a row of some 60 bytes each, are sent to every executor.
SENT_SOURCES = 100_000
WEIGHTS = (3, 1, 2)
SHARE = 1.5
LIMIT = 2.0
SEED = 20_240_601
_SOURCE = ("no_source", "source_key")


def sainte_lague(frame: DataFrame, group: list[str], weight: str, seats: str, ties: list[str]) -> DataFrame:
    """`frame` with `quota`: the `seats` of each group dealt to its rows by highest weight / (2j + 1).

    With a divisor a little above the fair one every row surely wins all but its last seats, with one a
    little below it surely wins no more than a few. Only the seats between are listed and ranked, at most
    a few times as many as there are rows, however many seats there are.
    """
    within = Window.partitionBy(*group)
    total, rows = F.sum(weight).over(within), F.count(F.lit(1)).over(within)
    spare = F.col(seats) - rows / 2
    sure = F.floor(F.col(weight) / (F.col("_total") / spare) + 0.5) - 1
    most = F.floor(F.col(weight) / (F.col("_total") / (F.col(seats) + rows / 2)) + 0.5) + 1
    keys = [*group, *ties]
    bounded = (
        frame.withColumns({"_total": total})
        .withColumns(
            {
                "_sure": F.when((F.col(weight) > 0) & (spare > 0), F.greatest(sure, F.lit(0))).otherwise(0).cast("long"),
                "_most": F.when(F.col(weight) > 0, most).otherwise(0).cast("long"),
            }
        )
        .withColumn("_left", F.col(seats) - F.sum("_sure").over(within))
    )
    listed = bounded.select(
        "*",
        F.explode_outer(
            F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1))
        ).alias("_seat"),
    )
    ranked = listed.withColumn(
        "_rank",
        F.row_number().over(
            within.orderBy((F.col(weight) / (2 * F.col("_seat") + 1)).desc_nulls_last(), *ties)
        ),
    )
    won = (F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long")
    kept = [c for c in frame.columns if c not in keys]
    return ranked.groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in kept), (F.first("_sure") + F.sum(won)).alias("quota")
    )


def targets(sizes: DataFrame) -> DataFrame:
    """One row per source: `source_size`, `cap` (the most it can give) and `target`.

    The targets share SHARE of all words by weight; none is above LIMIT times its source, and what that
    cuts off goes to the others by weight. In the order of limit per weight the capped sources come first;
    the first source that stays below its limit fixes the words per weight (`level`) of all after it.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(*_SOURCE))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place - 1) % len(WEIGHTS) + 1)
    by_ratio = everything.orderBy("ratio", *_SOURCE)
    capped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    words = F.sum("source_size").over(everything)
    below = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", *_SOURCE, "level"))
    return (
        sizes.groupBy(*_SOURCE)
        .agg(F.sum("size").alias("source_size"))
        .withColumns({"weight": weight, "cap": LIMIT * F.col("source_size")})
        .withColumns({"ratio": F.col("cap") / F.col("weight"), "words": words})
        .withColumn("level", (SHARE * F.col("words") - capped) / rest)
        .withColumn("level", F.min(below).over(everything)["level"])
        .select(
            *_SOURCE,
            "source_size",
            "cap",
            F.least("cap", F.coalesce("level", F.lit(0.0)) * F.col("weight")).alias("target"),
        )
    )


def sized(docs: DataFrame, text: Column, source: Column, identity: Column, keep: Column | None = None) -> DataFrame:
    """What the mix needs of each document, `keep` carried along as `row`."""
    draw = F.xxhash64(F.lit(SEED), identity, text)
    return docs.select(
        source.isNull().alias("no_source"),
        F.coalesce(source, F.lit("")).alias("source_key"),
        words_of(text).alias("size"),
        draw.alias("draw"),
        (identity if keep is None else keep).alias("row"),
    )


def mix(rows: DataFrame) -> DataFrame:
    """`row` of each document of `sized` with its size, its source's size and target, and what is taken:
    `passes` times the whole, and the words of `spans` (from, to; counted from 0) besides."""
    sources = targets(rows)
    # Sources at their limit are left out of the deal.
    everything = Window.partitionBy(F.lit(0))
    full = F.col("target") >= F.col("cap")
    left = F.round(F.sum("target").over(everything)) - F.sum(F.when(full, F.floor("cap")).otherwise(0)).over(everything)
    dealt = sources.withColumns(
        {"everything": F.lit(0), "open": F.when(full, 0.0).otherwise(F.col("target")), "words": F.greatest(left, F.lit(0)).cast("long")}
    )
    plan = sainte_lague(dealt, ["everything"], "open", "words", [*_SOURCE])
    plan = plan.select(*_SOURCE, "source_size", "target", F.when(full, F.floor("cap")).otherwise(F.col("quota")).cast("long").alias("words"))
    plan = plan.withColumn(
        "shards", F.least(F.lit(MOST_SHARDS), F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)))
    )
    # Few sources go to the documents, so that those of a hot source stay where they are.
    plan = stored(plan, "mix-sources")
    plan = F.broadcast(plan) if plan.count() <= SENT_SOURCES else plan
    placed = rows.join(plan, [*_SOURCE]).withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "draw"), F.col("shards")))
    shards = sainte_lague(
        placed.groupBy(*_SOURCE, "shard").agg(F.sum("size").alias("shard_size"), F.first("words").alias("words")),
        [*_SOURCE], "shard_size", "words", ["shard"],
    )
    fit = F.least(F.col("quota"), F.floor(LIMIT * F.col("shard_size")).cast("long"))
    ring = F.col("shard_size")
    shards = shards.select(
        *_SOURCE, "shard", "shard_size",
        F.when(ring > 0, F.floor(fit / ring)).otherwise(0).alias("passes"),
        F.when(ring > 0, fit % ring).otherwise(0).alias("rest"),
        F.when(ring > 0, F.pmod(F.xxhash64(F.lit(SEED), *_SOURCE, "shard"), F.ceil(ring / BLOCK)) * BLOCK).otherwise(0).alias("begin"),
    )
    line = Window.partitionBy(*_SOURCE, "shard").orderBy("draw", "size")
    size, start = F.col("size"), F.col("start")
    spans = [
        F.struct(
            F.greatest(F.col("begin") - lap - start, F.lit(0)).cast("long").alias("from"),
            F.least(F.col("begin") - lap + F.col("rest") - start, size).cast("long").alias("to"),
        )
        for lap in (F.lit(0), ring)
    ]
    taken = F.aggregate("spans", F.col("passes") * size, lambda n, x: n + x["to"] - x["from"])
    return (
        placed.join(shards, [*_SOURCE, "shard"])
        .withColumn("start", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - size)
        .withColumn("spans", F.filter(F.array(*spans), lambda x: x["to"] > x["from"]))
        .select("row", "size", "source_size", "target", "passes", "spans", taken.cast("long").alias("taken"))
    )


def mixed_texts(docs: DataFrame, text: str, source: str, identity: str) -> DataFrame:
    """The documents of the mix, with all columns of `docs`: a row for each time the whole is taken, and one for each run
    of words besides, holding just those words and the blanks before them. A document of which nothing is
    taken has no row."""
    rows = mix(sized(docs, F.col(text), F.col(source), F.col(identity), F.struct(*docs.columns)))
    whole = F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("to"))
    copies = F.concat(F.array_repeat(whole, F.when(F.col("size") > 0, F.col("passes")).otherwise(0).cast("int")), "spans")
    # Cut after each word, so that a word keeps the blanks before it.
    pieces = F.split(F.col(f"row.{text}"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.array_join(F.slice(pieces, F.col("span.from").cast("int") + 1, (F.col("span.to") - F.col("span.from")).cast("int")), "")
    cut = F.when(F.col("span.to") - F.col("span.from") == F.col("size"), F.col(f"row.{text}")).otherwise(part)
    spread = rows.select("row", "size", F.explode(copies).alias("span"))
    return spread.select(*((cut if c == text else F.col("row")[c]).alias(c) for c in docs.columns))
