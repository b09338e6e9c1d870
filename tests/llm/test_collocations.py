"""Collocations against plain counts and their SQL, with colliding fingerprints, NULLs, ties, repeated rows and empty tables."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from compare import differences
from pondside.llm import collocations, queries
from pondside.llm.common import ARROW_BYTES

FOLDER = "/root/testdata/sf0.001"
DRAW = random.Random(4)
WORDS = ["Pond", "mill", "the", "of", "Étang", "été", "a", "b", "x\x00y", "池塘", "OLD"]
TEXTS = [
    (i, DRAW.choice([" ", "  ", "\t", ", ", ".", "\n", "\x0b", " \r\n"]).join(DRAW.choices(WORDS, weights=range(11, 0, -1), k=DRAW.randrange(40))), DRAW.choice(["en", "fr", None]), "s")
    for i in range(150)
]
TEXTS += [(1, None, "en", "s"), (2, "", "en", "s"), (3, " \t\n.", "de", None), (None, "the old mill", None, None)]
TEXTS += [(4, "the old mill of the pond " * 3000, "en", "s")] * 2


def expected(rows, least, most):
    total, runs = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            runs.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in runs.items() if a >= least and len(key[1]) > 1}
    found = {}
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 100 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if inside:
            continue
        cuts = [(runs[lang, words[:k]], runs[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((1000 * a * total[lang] // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, k + 1, phrase.decode(), -a, l, r, total[lang], -score)
        for lang, phrases in found.items()
        for k, (score, a, phrase, l, r) in enumerate(sorted(phrases)[:most])
    )


@pytest.mark.parametrize("most", [4, 2000])
def test_equals_plain_counts(documents, most):
    found = collocations.collocations(documents(TEXTS), "text", "lang", 7, most).collect()
    assert sorted(map(tuple, found)) == expected(TEXTS, 7, most)


def test_colliding_fingerprints_are_told_apart():
    texts = pa.record_batch({"text": ["a b a c a b", "a b. c"], "lang": ["en", "fr"]})
    words = collocations.Words.of(texts)
    at = np.array([0, 1, 2, 4, 6])
    first, times = collocations._verified(words, 2, at, np.zeros(5, np.uint64))
    assert sorted(zip(at[first].tolist(), times.tolist(), strict=True)) == [(0, 2), (1, 1), (2, 1), (6, 1)]


@pytest.mark.parametrize(("held", "bits"), [(50, 1 << 26), (500_000, 1 << 6)])
def test_neither_small_parts_nor_a_full_filter_matter(documents, monkeypatch, held, bits):
    """The functions of the tasks, run here, where they see smaller settings."""
    for name in ("SLICE", "HELD", "ROWS"):
        monkeypatch.setattr(collocations, name, held)
    monkeypatch.setattr(collocations, "FILTER", bits)
    texts = [r for r in TEXTS if len(r[1] or "") < 1000]
    batch = pa.record_batch({"place": list(range(len(texts))), "text": [r[1] or "" for r in texts], "lang": [r[2] or "und" for r in texts]})

    class Sent:
        value = b"\xff" * (bits // 8)

    sums = {}
    for sizes, sent in ((range(1, 3), None), (range(3, 6), Sent)):
        for part in collocations._counted(sizes, sent)(iter([batch])):
            for row in part.to_pylist():
                n, place = sums.get((row["fp"], row["check"]), (0, row["place"]))
                sums[row["fp"], row["check"]] = n + row["n"], min(place, row["place"])
    wanted = [[] for _ in texts]
    for (fp, check), (n, place) in sums.items():
        wanted[place].append({"fp": fp, "check": check, "n": n})
    kind = pa.list_(pa.struct({"fp": pa.int64(), "check": pa.int64(), "n": pa.int64()}))
    batch = batch.append_column("wanted", pa.array(wanted, kind))
    rows = [r for part in collocations._read(iter([batch])) for r in part.to_pylist()]
    plain = Counter()
    for _, text, lang, _ in texts:
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            plain.update((lang or "und", k, " ".join(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    assert {(r["lang"], r["words"], r["phrase"]): r["n"] for r in rows} == plain and len(rows) == len(plain)


def test_empty_tables_give_no_rows(documents):
    assert collocations.collocations(documents([]), "text", "lang").count() == 0


def test_large_numbers_stay_exact(spark):
    row = spark.sql(
        "SELECT (1000BD * CAST(a AS DECIMAL(16, 0)) * CAST(n AS DECIMAL(16, 0))) DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0))) AS s"
        " FROM VALUES (1234567890123L, 9876543210987654L, 98765432109876L, 87654321098765L) t(a, n, l, r)"
    ).first()
    assert row["s"] == 1000 * 1234567890123 * 9876543210987654 // (98765432109876 * 87654321098765)


def test_query_equals_its_sql(spark):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
        assert differences(queries.op11_collocations(spark, FOLDER), connection, queries.ORACLE_SQL["op11_collocations"]) is None


def test_texts_reach_the_workers_in_small_batches(documents, spark, monkeypatch):
    class Stored(Exception):
        pass

    def sizes_of(sizes, sent=None):
        def run(batches):
            for batch in batches:
                place = batch.column("place")[0].as_py()
                yield pa.RecordBatch.from_pydict({"fp": [place], "check": [batch.num_rows], "n": [batch.nbytes], "place": [place]})

        return run

    def stop(rows, name):
        raise Stored(rows.collect())

    monkeypatch.setattr(collocations, "_counted", sizes_of)
    monkeypatch.setattr(collocations, "stored", stop)
    spark.conf.unset(ARROW_BYTES)
    docs = documents([(i, "pond " * 4000 + str(i), "en") for i in range(600)])
    try:
        with pytest.raises(Stored) as found:
            collocations.phrases(docs, "text", "lang", 1)
    finally:
        spark.conf.unset(ARROW_BYTES)
    rows = found.value.args[0]
    assert sum(r["check"] for r in rows) == 600 and max(r["n"] for r in rows) < 4_000_000


def test_few_rows_are_stored_in_few_files(documents, spark, monkeypatch):
    files, stored = {}, collocations.stored

    def counted(rows, name):
        files[name] = len((kept := stored(rows, name)).inputFiles())
        return kept

    monkeypatch.setattr(collocations, "stored", counted)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = collocations.collocations(documents(TEXTS), "text", "lang", 100).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        spark.conf.unset(ARROW_BYTES)
    assert sorted(map(tuple, found)) == expected(TEXTS, 100, 2000)
    assert len(files) == 5 and max(files.values()) <= 2, files
