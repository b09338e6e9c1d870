"""A bounded sample of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample(docs: DataFrame, labels: DataFrame, identity: str, label: str, most: int) -> DataFrame:
    """At most `most` labelled rows of `docs` in `row`, drawn by a hash of the id, with their `label` (0 or 1).

    Of an id labelled more than once the larger label counts. The ids drawn, at most `most`, are sent to the
    documents."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(identity).isNotNull())
    known = known.groupBy(F.col(identity).alias("id")).agg(F.max(label).cast("double").alias("label"))
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumn("id", F.col(f"row.{identity}"))
    return rows.join(F.broadcast(drawn), "id").select("row", "label")
