"""What both vector searches share: usable rows, and the merge of partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import stored


def usable(frame: DataFrame, identity: str, vector: str, query: Column, whole: Column) -> DataFrame:
    """Rows with an id and a non-empty vector of finite numbers, numbered by `row_id`; `query` says which ask."""
    fine = F.col(identity).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.filter(fine & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(identity).cast("long").alias("vec_id"),
        F.coalesce(query, F.lit(False)).alias("asks"),
        whole.alias("vector"),
    )
    return stored(rows, "vectors")


def best(found: DataFrame, most: int, score: str) -> DataFrame:
    """The `most` highest of each query (`query_row`, `query_id`), ties to the smaller id; `score` is the result's type."""
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", F.col("score").cast(score).alias("score"))
