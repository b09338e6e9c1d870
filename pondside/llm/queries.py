"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pondside.llm import (
    bond,
    bpe,
    collocations,
    crosspolytope,
    langid,
    linededup,
    minhash,
    mixing,
    quality,
    simhash,
    suffixdedup,
    toxicity,
    vafile,
)
from pondside.llm.common import fold, stored, table

GOOD, TOXIC = 0.3, 0.7
NEAREST = 20
SHINGLE, BITS = 3, 3
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_spec(path: str | None = None) -> str:
    """The tokenizer's JSON, read where the query is built and sent along."""
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as file:
        return file.read()


def _at_least(score: str, bound: float) -> Column:
    return (F.col(score) >= bound).cast("int").alias("predicted")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.deduped(docs, "doc_id", "text").select(
        "row.doc_id",
        F.col("lines").cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixdedup.without_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return left.select(
        F.col("id").alias("doc_id"),
        F.col("bytes").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vafile.top_k(rows, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 64, NEAREST)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return crosspolytope.nearest(rows, "vec_id", "embedding", F.col("vec_id") % 20 == 0, NEAREST)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = quality.train(docs.filter(~held_out), table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    scored = quality.scored(docs, model, "text").withColumn("doc_id", F.col("row.doc_id"))
    held_out = fold(F.col("doc_id"), 5) == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", _at_least("score", GOOD))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.fingerprints(table(spark, sf_dir, "documents"), "text", SHINGLE, ["doc_id"])
    prints = stored(rows.select(F.col("row.doc_id").alias("doc_id"), "fp"), "fingerprints")
    named = simhash.near_duplicates(prints, "doc_id", BITS)
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = mixing.sized(docs, F.col("text"), F.col("source"), F.col("doc_id"))
    mixed = mixing.mix(stored(sizes, "op7"))
    return mixed.select(F.col("row").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    scored = toxicity.scored(docs.withColumn("held_out", held_out), model, "text")
    return scored.select("row.doc_id", "row.held_out", "score", _at_least("score", TOXIC))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.train(docs.filter(~held_out), "text", "lang")
    predicted = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, "text")
    return predicted.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe.round_trip(docs, "doc_id", "text", tokenizer_spec())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), "text", "lang")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings")
    return bond.hard_negatives(rows, "vec_id", "embedding", label, F.col("vec_id") % 100 == 0, 256)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.compared(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("chars").alias("n_chars"),
        "edited_sha256",
        minhash.shown(F.col("print")).alias("fingerprint"),
        minhash.shown(F.col("edited_print")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_nearest": op4_nearest,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_langid": op9_langid,
    "op10_bpe": op10_bpe,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_fingerprints": op13_fingerprints,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_top_k": f"""
        WITH usable AS (
            SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM usable q JOIN usable c ON len(c.v) = len(q.v) AND c.vec_id <> q.vec_id
            WHERE q.vec_id % 20 = 0
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {NEAREST}
    """,
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang,
                    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) AS piece
                FROM documents) cut
        ),
        totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
        known AS (
            SELECT lang, phrase, size, count(*) AS a
            FROM (SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
                FROM pieces, range(1, 6) sizes(size)) runs
            GROUP BY lang, phrase, size HAVING count(*) >= 100
        ),
        cuts AS (
            SELECT p.lang, p.phrase, p.size, p.a, k,
                array_to_string(string_split(p.phrase, ' ')[1 : k], ' ') AS head,
                array_to_string(string_split(p.phrase, ' ')[k + 1 :], ' ') AS rest
            FROM known p, range(1, 5) places(k) WHERE k < p.size
        ),
        scored AS (
            SELECT c.*, x.a AS l, y.a AS r, t.n,
                CAST((1000 * CAST(c.a AS HUGEINT) * CAST(t.n AS HUGEINT)) // (CAST(x.a AS HUGEINT) * CAST(y.a AS HUGEINT)) AS BIGINT) AS score
            FROM cuts c JOIN totals t ON t.lang = c.lang
            JOIN known x ON x.lang = c.lang AND x.phrase = c.head
            JOIN known y ON y.lang = c.lang AND y.phrase = c.rest
        ),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ),
        kept AS (
            SELECT * FROM lowest c WHERE NOT EXISTS (
                SELECT 1 FROM known o WHERE o.lang = c.lang AND o.size > c.size AND 100 * o.a >= 100 * c.a
                  AND contains(concat(' ', o.phrase, ' '), concat(' ', c.phrase, ' ')))
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
        )
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
    """,
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT row_number() OVER () AS row_id, vec_id, len(embedding) AS dim,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT a.row_id AS anchor, a.vec_id AS anchor_id, c.row_id, c.vec_id, a.label = c.label AS alike,
                CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
            FROM usable a JOIN usable c ON c.dim = a.dim AND c.row_id <> a.row_id
            WHERE a.vec_id % 100 = 0
        ),
        positives AS (
            SELECT anchor, anchor_id, row_id AS positive, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row_id) <= 5
        ),
        ranked AS (
            SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
                CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id, s.row_id) AS INTEGER)
                    AS rank
            FROM positives p JOIN scored s ON s.anchor = p.anchor
            WHERE NOT s.alike AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
    """,
}
