"""Rollups kept up from what changed, without reading all visits and observations again.

Two states are kept as tables: the visits of each site and day, and the observations of each visit. A state counts rows under
its key, and counts of two sets of rows add up, those of removed rows as negative ones; the last visit of a site is the latest
day that still has any, which a plain maximum could not tell after a deletion. What changed comes as rows with a `sign`: 1 for a
row that is there now, -1 for one that is gone, both for one that was changed.

State tables are partitioned by a hash of the key. A batch is summed under the keys first and only the partitions of those
keys are read and written again. Each partition holds the number of the last batch applied to it, so a batch that was cut off is
completed by running it again and no row counts twice. Batches are numbered from 1 and applied in order.

Defined results: rows with a NULL key belong to nothing and take no part; a batch that takes away more than there is raises
`Unmatched` and leaves the state as it was; an empty batch writes nothing; a batch whose number a partition has seen leaves
that partition alone, so one that repeats has no effect.
"""

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from pondside.operators.rollups import group_counts, site_counts, visit_counts
from pondside.plans.merge import dynamic_overwrite
from pondside.sources.tables import Survey

# Keys of each state; the first names the record that its rows belong to and places them.
STATES: Mapping[str, tuple[str, ...]] = {
    "visits_of_site": ("id_base_site", "visit_date_min"),
    "observations_of_visit": ("id_base_visit",),
}
RELATION = {"visits_of_site": "visits", "observations_of_visit": "observations"}
PARTS = 64


class Unmatched(ValueError):
    """A batch that takes away rows a state does not count."""


def counted(state: str, rows: DataFrame) -> DataFrame:
    """Signed rows summed under the keys of a state; keys whose rows cancel out are left out."""
    keys = STATES[state]
    summed = rows.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.sum("sign").alias("n"))
    return summed.where("n <> 0")


def signed(before: DataFrame, now: DataFrame) -> DataFrame:
    """What turns one state of a relation into another: rows that are gone with sign -1, those that are new with 1.

    Equal rows of both are summed before the shuffle and cancel out."""
    both = before.withColumn("sign", F.lit(-1)).unionByName(now.withColumn("sign", F.lit(1)))
    summed = both.groupBy(*now.columns).agg(F.sum("sign").alias("sign"))
    return summed.where("sign <> 0")


def merged(state: str, kept: DataFrame, delta: DataFrame) -> DataFrame:
    """A state with the counts of a batch added."""
    keys = STATES[state]
    both = kept.select(*keys, "n").unionByName(delta.select(*keys, "n"))
    return both.groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def relation_rows(db: Survey, state: str) -> DataFrame:
    """The columns of a relation that a state is made from."""
    return db[RELATION[state]].select(*STATES[state])


def _with_part(state: str, rows: DataFrame, parts: int) -> DataFrame:
    part = F.pmod(F.xxhash64(F.col(STATES[state][0]).cast("bigint")), F.lit(parts))
    return rows.withColumn("part", part.cast("int"))


def _marked(state: str, rows: DataFrame, places: DataFrame, batch: int) -> DataFrame:
    """Rows of a state with a row of NULL key for each partition, that holds the batch even where no other row is left."""
    none = [F.lit(None).cast(kind).alias(name) for name, kind in rows.dtypes if name in STATES[state]]
    marks = places.select(*none, F.lit(0).cast("bigint").alias("n"), "part")
    return rows.select(*STATES[state], "n", "part").unionByName(marks).select(
        *STATES[state], "n", F.lit(batch).cast("bigint").alias("batch"), "part"
    )


def _write(rows: DataFrame, table: str) -> None:
    rows.hint("rebalance", "part").write.partitionBy("part").format("parquet").saveAsTable(table)


def start(db: Survey, database: str, parts: int = PARTS) -> None:
    """Make the states from all rows of the relations, as batch 0."""
    spark = db["visits"].sparkSession
    for state in STATES:
        rows = counted(state, relation_rows(db, state).withColumn("sign", F.lit(1)))
        places = spark.range(parts).select(F.col("id").cast("int").alias("part"))
        _write(_marked(state, _with_part(state, rows, parts), places, 0), f"{database}.{state}")


def apply_batch(spark: SparkSession, database: str, batch: int, changes: Mapping[str, DataFrame]) -> dict[str, int]:
    """Bring states up to date with a batch; `changes` are signed rows by state. The partitions written of each state."""
    return {state: _apply(spark, f"{database}.{state}", state, batch, rows) for state, rows in changes.items()}


def _apply(spark: SparkSession, table: str, state: str, batch: int, rows: DataFrame) -> int:
    if batch < 1:
        raise ValueError("batches are numbered from 1")
    # One row for each partition, of which there are as many as the state was started with.
    last = {r["part"]: r["last"] for r in spark.table(table).groupBy("part").agg(F.max("batch").alias("last")).collect()}
    beside = [f"{table}_{name}_{uuid.uuid4().hex}" for name in ("delta", "staged")]
    try:
        _write(_with_part(state, counted(state, rows), len(last)), beside[0])
        delta = spark.table(beside[0])
        touched = [r["part"] for r in delta.select("part").distinct().collect()]
        places = sorted(part for part in touched if last[part] < batch)
        if not places:
            return 0
        here = F.col("part").isin(places)
        both = merged(state, spark.table(table).where(here & F.col(STATES[state][0]).isNotNull()), delta.where(here))
        marks = spark.createDataFrame([(part,) for part in places], "part int")
        _write(_marked(state, _with_part(state, both, len(last)), marks, batch), beside[1])
        staged = spark.table(beside[1])
        if not staged.where("n < 0").isEmpty():
            raise Unmatched(f"{table}: batch {batch} takes away rows that are not there")
        with dynamic_overwrite(spark):
            staged.select(spark.table(table).columns).write.mode("overwrite").insertInto(table)
        return len(places)
    finally:
        for name in beside:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _state(spark: SparkSession, database: str, state: str) -> DataFrame:
    return spark.table(f"{database}.{state}").where(F.col(STATES[state][0]).isNotNull())


def rollup_site(db: Survey, database: str) -> DataFrame:
    """Visits and last visit of each site, from the state."""
    spark = db["sites"].sparkSession
    return site_counts(db, visits_by_site(_state(spark, database, "visits_of_site")))


def rollup_group(db: Survey, database: str) -> DataFrame:
    """Sites and visits of each group, from the state."""
    spark = db["sites"].sparkSession
    return group_counts(db, visits_by_site(_state(spark, database, "visits_of_site")))


def rollup_visit(db: Survey, database: str) -> DataFrame:
    """Observations of each visit, from the state."""
    spark = db["visits"].sparkSession
    return visit_counts(db, observations_by_visit(_state(spark, database, "observations_of_visit")))


def visits_by_site(state: DataFrame) -> DataFrame:
    """Visits and last visit of the sites in a state."""
    return state.groupBy("id_base_site").agg(F.sum("n").alias("nb_visits"), F.max("visit_date_min").alias("last_visit"))


def observations_by_visit(state: DataFrame) -> DataFrame:
    """Observations of the visits in a state."""
    return state.select("id_base_visit", F.col("n").alias("nb_observations"))
