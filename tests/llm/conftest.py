import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that the operators use themselves.
        T.StructField("row", T.StringType()),
        T.StructField("key", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("line", T.StringType()),
    ]
)


@pytest.fixture
def documents(spark, tmp_path):
    """Builds a table of documents from (doc_id, text, lang, source), with columns of clashing names."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), "r", 1, 0.5, "l") for r in rows]
        path = f"{tmp_path}/documents-{len(rows)}-{abs(hash(str(rows)))}"
        spark.createDataFrame(full, DOCS).coalesce(2).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return build
