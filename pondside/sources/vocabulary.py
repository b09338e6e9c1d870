"""Vocabulary documents: nested JSON with an array of types and an array of entries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pondside.functions.payload import one_each
from pondside.schemas import VOCABULARY_DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per vocabulary file, as text."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "document")


def _items(documents: DataFrame, part: str) -> DataFrame:
    parsed = documents.select(F.from_json("document", VOCABULARY_DOCUMENT).alias("content"))
    return one_each(parsed, [], F.col(f"content.{part}"), "item").select("item.*")


def vocabulary_types(documents: DataFrame) -> DataFrame:
    """The types of all documents: code, label, definition."""
    return _items(documents, "types").select(
        F.col("mnemonique").alias("type"),
        F.col("label_default").alias("label"),
        F.trim("definition_default").alias("definition"),
    )


def vocabulary_entries(documents: DataFrame) -> DataFrame:
    """The entries of all documents: type, code, mnemonic, label, definition."""
    return _items(documents, "nomenclatures").select(
        "type",
        F.col("cd_nomenclature").alias("code"),
        F.col("mnemonique").alias("mnemonic"),
        F.col("label_default").alias("label"),
        F.trim("definition_default").alias("definition"),
    )
