"""A pipeline over documents: a row of stages, each with one operator of `pondside.llm`.

The function of a stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pondside.llm import bpe, linededup, mixing, quality, simhash
from pondside.llm.common import fold, stored, table
from pondside.llm.queries import BITS, GOOD, SHINGLE, tokenizer_spec


def _with_text(docs: DataFrame, text) -> DataFrame:
    """`docs` with another text, and its length where that is a column."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from labelled ones outside the held-out fold."""
    learned = docs.filter(fold(F.col("doc_id"), 5) != 0)
    model = quality.train(learned, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return quality.scored(docs, model, "text").filter(F.col("score") >= GOOD).select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines that are the first of their kind."""
    left = linededup.deduped(docs, "doc_id", "text")
    kept = _with_text(left.select("row.*", "kept"), F.col("kept"))
    return kept.select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near copies."""
    return simhash.first_of_each(docs, "doc_id", "text", SHINGLE, BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes: a row for each time a document is taken whole, one for each part."""
    return _with_text(mixing.mixed_texts(docs, "text", "source", "doc_id"), F.col("text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, which decode to the text."""
    coded = bpe.round_trip(docs, "doc_id", "text", tokenizer_spec())
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256")
    )


STAGES = [
    ("good documents", good_documents),
    ("lines once", without_repeated_lines),
    ("one of near copies", one_of_near_copies),
    ("sources mixed to target weights", mix_sources),
    ("token ids", encode),
]

# SQL can express neither the encoding nor the learned stages; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
