"""Hard negatives against brute force and their SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences
from pondside.llm import bond, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score double"


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(9)
    middle = draw.normal(size=(4, 20))
    found = [(i, (middle[i % 3] + middle[3] + draw.normal(size=20)).astype(np.float32).tolist(), i % 3) for i in range(300)]
    found[41] = (41, found[40][1], 2)  # a tie across labels
    found[43] = (43, found[40][1], 1)  # and one within
    odd = [(500, None, 1), (510, [], 1), (520, [None] * 20, 1), (530, [float("nan")] * 20, 1), (540, [float("-inf")] * 20, 1)]
    odd += [(550, found[0][1], None), (None, found[0][1], 1), (560, [0.5, 1.0], 1), (570, [0.4, 1.0], 1), (580, [0.45, 1.0], 2), (590, [0.0] * 20, 0)]
    return [*found, found[30], *odd, (600, [1.0] * 3, 7)]


def expected(rows, scale, asks, k=5):
    usable = [(i, np.floor(scale * np.array(v, float)).astype(int), c) for i, v, c in rows if i is not None and c is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for n, (i, v, c) in enumerate(usable):
        if not asks(i):
            continue
        others = sorted((-int(v @ w), j, m, d == c) for m, (j, w, d) in enumerate(usable) if m != n and len(w) == len(v))
        for p, pid, _, _ in [x for x in others if x[3]][:k]:
            hard = [x for x in others if not x[3] and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(i, pid, r + 1, x[1], -p, -x[0]) for r, x in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("least", [20, 4096])
def test_equals_brute_force(spark, monkeypatch, rows, least):
    monkeypatch.setattr(bond, "LEAST", least)
    monkeypatch.setattr(bond, "BLOCK", 3 * least)
    frame = spark.createDataFrame([(*r, 1, 0.5) for r in rows], SCHEMA)
    found = bond.hard_negatives(frame, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 10 == 0, 16).collect()
    wanted = expected(rows, 16, lambda i: i % 10 == 0)
    assert len(wanted) > 300 and any(r[5] == r[4] for r in wanted)
    assert sorted(map(tuple, found)) == wanted


def test_the_scan_drops_rows_before_their_end():
    draw = np.random.default_rng(2)
    vectors = draw.integers(-9, 10, (500, 64))
    vectors[:, :4] *= 100
    block = bond.Block.of(np.arange(500), np.arange(500), np.arange(500) % 2, vectors)
    left = []

    def stay(lower, upper):
        bitmap = upper >= np.partition(lower, -5)[-5]
        left.append(int(bitmap.sum()))
        return bitmap

    at, scores = block.scan(vectors[7], np.arange(500), stay)
    exact = block.columns.T @ vectors[7]
    assert (scores == exact[at]).all() and set(np.argsort(-exact)[:5]) <= set(at.tolist())
    assert left[0] < 250 and left == sorted(left, reverse=True)


def test_empty_tables_and_lone_labels_give_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    ask = F.col("vec_id") % 10 == 0
    assert bond.hard_negatives(empty, "vec_id", "embedding", F.col("label"), ask, 16).count() == 0
    one = spark.createDataFrame([(10, [1.0], 1, 1, 0.5), (20, [1.0], 2, 1, 0.5)], SCHEMA)
    assert bond.hard_negatives(one, "vec_id", "embedding", F.col("label"), ask, 16).count() == 0


def test_query_equals_its_sql(spark):
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
        assert differences(queries.op12_hard_negatives(spark, FOLDER), connection, queries.ORACLE_SQL["op12_hard_negatives"]) is None
