"""Vector searches against brute force."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences
from pondside.llm import crosspolytope, queries, vafile

SCHEMA = "vec_id long, embedding array<float>, score double, rank int"


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(5)
    found = [(i, draw.normal(size=24).astype(np.float32)) for i in range(400)]
    found = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in found]
    found[41] = (41, found[40][1])  # a tie
    odd = [(500, None), (520, []), (540, [None] * 24), (560, [float("nan")] * 24), (580, [float("inf")] * 24), (600, [0.5] * 3), (None, found[0][1])]
    return [*found, found[20], *odd]


def expected(rows, scale, k):
    usable = [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    vectors = [np.floor(scale * np.array(v, float)) if scale else np.array(v, float) for _, v in usable]
    out = []
    for n, (i, _) in enumerate(usable):
        if i % 20 == 0:
            near = [(-float(vectors[n] @ vectors[m]), j) for m, (j, _) in enumerate(usable) if m != n and len(vectors[m]) == len(vectors[n])]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [20, 150, vafile.BLOCK])
def test_exact_search_equals_brute_force(spark, monkeypatch, rows, block):
    monkeypatch.setattr(vafile, "BLOCK", block)
    frame = spark.createDataFrame([(*r, 0.0, 0) for r in rows], SCHEMA)
    found = vafile.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 64, 5).collect()
    assert sorted((r[0], r[1], r[2], float(r[3])) for r in found) == expected(rows, 64, 5)


@pytest.mark.parametrize("piece", [20, crosspolytope.PIECE])
def test_recall_of_cross_polytopes(spark, monkeypatch, rows, piece):
    monkeypatch.setattr(crosspolytope, "PIECE", piece)
    frame = spark.createDataFrame([(*r, 0.0, 0) for r in rows], SCHEMA)
    found = crosspolytope.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5).collect()
    wanted = {(a, c) for a, _, c, _ in expected(rows, None, 5)}
    got = {(r["query_id"], r["vec_id"]) for r in found}
    assert len(wanted & got) >= 0.9 * len(wanted)
    by_id = {i: np.array(v, float) for i, v in rows if i is not None and i < 500}
    assert all(abs(r["score"] - by_id[r["query_id"]] @ by_id[r["vec_id"]]) < 1e-12 for r in found)


def test_the_transform_and_the_probes_are_those_defined():
    draw = np.random.default_rng(3)
    for width in (1, 2, 8, 64, 128, 512):
        signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(width)] for i in range(width)], float)
        x = draw.normal(size=(5, width))
        assert np.allclose(crosspolytope.hadamard(x), x @ signs)
    x = crosspolytope.on_sphere(draw.normal(size=(7, 24)), np.full((7, 1), 20.0), True)
    for level in (0, 1, 4, 6, 9, 13):
        parts = crosspolytope.parts_of(level, x.shape[1])
        assert np.prod([2 * a for a in parts]) == 2**level
        row, shelf, leaf = crosspolytope.probed(x, 2, level)
        near = [crosspolytope.turned(x, 2, n, axes) for n, axes in enumerate(parts)]
        for n in range(len(x)):
            cost = np.zeros(1)
            for part in near:
                cost = (cost[:, None] + ((part[n].max() - part[n]) ** 2)[None]).ravel()
            last = 2 * parts[-1] if parts else 1
            got = sorted(cost[shelf[row == n] * last + leaf[row == n]])
            assert np.allclose(got, np.sort(cost)[: crosspolytope.PROBES])
        own = crosspolytope.placed(x, 2, level)
        first = np.append(True, row[1:] != row[:-1])
        assert np.array_equal(np.column_stack(own), np.column_stack([shelf, leaf])[first])


def test_buckets_grow_with_the_rows():
    assert [crosspolytope.level_of(n) for n in (0, 1, 8, 2_000, 50_000, 10**9)] == [0, 0, 0, 8, 13, 27]


LENGTHS = {
    "one ten times as long": lambda draw, n: np.where(np.arange(n) == 7, 10.0, 1.0),
    "one a hundred times as long": lambda draw, n: np.where(np.arange(n) == 7, 100.0, 1.0),
    "over many orders": lambda draw, n: np.exp(2 * draw.normal(size=n)),
}


@pytest.mark.parametrize("fill", [2, crosspolytope.FILL])
@pytest.mark.parametrize("kind", LENGTHS)
def test_recall_with_unequal_lengths(spark, monkeypatch, kind, fill):
    monkeypatch.setattr(crosspolytope, "FILL", fill)
    draw = np.random.default_rng(11)
    x = draw.normal(size=(3000, 24))
    x *= (LENGTHS[kind](draw, len(x)) / np.linalg.norm(x, axis=1))[:, None]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame([(*r, 0.0, 0) for r in rows], SCHEMA)
    found = crosspolytope.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20).collect()
    wanted = {(a, c) for a, _, c, _ in expected(rows, None, 20)}
    got = {(r["query_id"], r["vec_id"]) for r in found}
    assert len(got) == len(wanted)
    assert len(wanted & got) >= 0.9 * len(wanted)


@pytest.mark.parametrize("fill", [1, crosspolytope.FILL])
def test_small_tables_give_all_there_is(spark, monkeypatch, fill):
    monkeypatch.setattr(crosspolytope, "FILL", fill)
    draw = np.random.default_rng(12)
    rows = [(i, (draw.normal(size=24) * 10.0 ** (i % 5)).astype(np.float32).tolist()) for i in range(21)]
    frame = spark.createDataFrame([(*r, 0.0, 0) for r in rows], SCHEMA)
    found = crosspolytope.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted((r[0], r[1], r[2]) for r in found) == [r[:3] for r in expected(rows, None, 20)]


def test_empty_tables_give_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert vafile.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 64, 5).count() == 0
    assert crosspolytope.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5).count() == 0


def test_exact_search_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
        assert differences(queries.op3_exact_top_k(spark, folder), connection, queries.ORACLE_SQL["op3_exact_top_k"]) is None
