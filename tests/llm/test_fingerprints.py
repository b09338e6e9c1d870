"""Document fingerprints against true likeness and a plain restatement of the edit."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pondside.llm import minhash, queries

FOLDER = "/root/testdata/sf0.001"
DRAW = random.Random(6)
WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(DRAW.choices(WORDS, k=3000))
TEXTS = [(i, " ".join(DRAW.choices(WORDS, k=DRAW.randrange(1, 900))), "en", "s") for i in range(0, 80, 2)]
TEXTS += [
    (1, None, "en", "s"), (3, "", None, None), (5, " \t\n", "en", "s"), (7, "one", "en", "s"), (9, "two", "en", "s"),
    (11, "één zwei 三つ 😀 " * 20, "en", "s"), (13, LONG, "en", "s"), (15, LONG + " x", "en", "s"), (17, LONG, "en", "s"),
    (81, LONG.split(" ", 1)[1] * 60, "en", "s"), (83, "a b c d e", "en", "s"), (85, "a  b\tc\nd e", "en", "s"),
]


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def true_likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    """Texts in order of id, each with its edit."""
    for text, after in zip(texts, [*texts[1:], texts[0]], strict=True):
        size = len(text) // 4
        yield text, text[: len(text) - size] + after[:size], after


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edits_and_likeness(spark, documents, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = minhash.compared(documents(TEXTS), "doc_id", "text").orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    texts = [text or "" for _, text, *_ in sorted(TEXTS, key=lambda r: r[0])]
    errors = []
    for row, (text, new, after) in zip(found, edited(texts), strict=True):
        assert row["chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        errors += [row["near_edited"] - true_likeness(text, new), row["near_next"] - true_likeness(text, after)]
    assert max(map(abs, errors)) < 0.16
    assert sum(map(abs, errors)) / len(errors) < 0.03
    assert abs(sum(errors) / len(errors)) < 0.01
    prints = {}
    for row, text in zip(found, texts, strict=True):
        prints.setdefault(" ".join(text.split()), set()).add(tuple(row["print"]))
        assert len(row["print"]) == (16 if text.strip() else 0)
    assert all(len(same) == 1 for same in prints.values()) and len(prints) < len(texts)


def test_fingerprints_as_hex_and_likeness_of_extremes(spark):
    rows = [("a b c d e f", "a b c d e f"), ("a b c d e f", "g h i j k l"), ("", None), ("", "a"), ("solo", "solo"), ("one", "two")]
    frame = spark.createDataFrame(rows, "a string, b string")
    prints = frame.select(minhash.fingerprint(F.col("a")).alias("a"), minhash.fingerprint(F.col("b")).alias("b"))
    found = prints.select(minhash.likeness(F.col("a"), F.col("b")).alias("near"), minhash.shown(F.col("a")).alias("hex")).collect()
    near = [r["near"] for r in found]
    assert near[0] == near[2] == near[4] == 1.0 and near[3] == 0.0
    assert near[1] < 0.06 and near[5] < 0.06
    assert re.fullmatch("[0-9a-f]{256}", found[0]["hex"]) and found[2]["hex"] == ""


def test_repeated_ids_and_rows_have_a_defined_order(documents):
    rows = [(1, "a b c d e f g h", "en", "s"), (1, "a b c d e f g h", "en", "s"), (None, "p q r s t u v w", None, None), (2, "x y z", None, None)]
    found = minhash.compared(documents(rows), "doc_id", "text").select("id", "edited_sha256").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    texts = ["p q r s t u v w", "a b c d e f g h", "a b c d e f g h", "x y z"]
    wanted = [(i, sha(new)) for i, (_, new, _) in zip([None, 1, 1, 2], edited(texts), strict=True)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_empty_and_single_row_tables(documents):
    assert minhash.compared(documents([]), "doc_id", "text").count() == 0
    row = minhash.compared(documents([(1, "abcdefgh", None, None)]), "doc_id", "text").first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def test_query_keeps_its_contract(spark):
    found = queries.op13_fingerprints(spark, FOLDER)
    kinds = {"doc_id": "bigint", "n_chars": "bigint", "near_edited": "double", "near_next": "double"}
    kinds |= dict.fromkeys(["edited_sha256", "fingerprint", "edited_fingerprint"], "string")
    assert dict(found.dtypes) == kinds
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = [r["text"] or "" for r in docs]
    rows = found.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == [r["doc_id"] for r in docs]
    for row, (text, new, _) in zip(rows, edited(texts), strict=True):
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert 0 <= row["near_edited"] <= 1 and abs(row["near_edited"] - true_likeness(text, new)) < 0.16
