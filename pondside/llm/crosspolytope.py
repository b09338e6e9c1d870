"""Approximate nearest neighbours by cross-polytope hashing.

A vector is put on the unit sphere and turned by three rounds of random signs and a fast Hadamard transform; the signed
axis nearest to it is one part of its bucket. Each of TABLES tables has turns of its own, and so has each part of a bucket. The
parts are as many as it takes to leave some FILL rows in a bucket, the last one over as few axes as that needs, so the
buckets grow with the rows. A query looks into the PROBES buckets of each table that are nearest to it, by the summed squares
of what each part's axis lacks to the nearest one, and everything found there is ranked by the exact inner product.
Largest inner product is made nearest angle by one more component, which brings vectors to one length. So that it stays small,
vectors are cut into ranges of lengths, each RATIO times as long as the next, and brought to the longest of their own range; where
all have unit length it is zero. Each range has buckets by its own number of rows. A query that finds fewer than k while
there are more looks at everything.

Buckets that differ in the last part only lie on one shelf, at most twice the padded length of them, so that a
query goes to a shelf once, with the list of buckets it looks into. A shelf of more than PIECE rows is cut into pieces that its
queries all visit, so a task holds one piece. Recall against brute force and the share of rows looked at: see README.

Defined results: rows without id, NULL, empty and zero vectors and those with NULL or non-finite components take no part;
vectors meet only those of their own length; repeated rows are candidates like others, and each asks for itself; ties
go to the smaller id; fewer candidates than k give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pondside.llm.common import stored
from pondside.llm.vectors import best, usable

TABLES = 16
PROBES = 64
FILL = 8
PIECE = 16_384
ROUNDS = 3
SEED = 7
RATIO = 2**0.25
HELD = 2_000_000
RADIX = 16
# Queries whose probes, and pairs whose scores, are worked out at a time.
ASKED, PAIRS = 256, 100_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, up to a factor, RADIX components at a step."""
    count, width = x.shape
    inner = min(width, RADIX)
    small = np.ones((1, 1))
    while len(small) < inner:
        small = np.kron(small, [[1.0, 1.0], [1.0, -1.0]])
    x = x.reshape(-1, inner) @ small
    if width == inner:
        return x.reshape(count, width)
    across = x.reshape(count, -1, inner).transpose(0, 2, 1).reshape(count * inner, -1)
    return hadamard(across).reshape(count, inner, -1).transpose(0, 2, 1).reshape(count, width)


def turned(x: np.ndarray, table: int, part: int, axes: int) -> np.ndarray:
    """Nearness of each row to the first signed axes of a part of a table: the positive ones, then the negative ones."""
    signs = np.random.default_rng([SEED, table, part, x.shape[1]]).choice([-1.0, 1.0], (ROUNDS, x.shape[1]))
    for sign in signs:
        x = hadamard(x * sign) / np.sqrt(x.shape[1])
    return np.concatenate([x[:, :axes], -x[:, :axes]], axis=1)


def level_of(rows: int) -> int:
    """Bits of a bucket, for so many rows."""
    return max(0, round(math.log2(max(1, rows) / FILL)))


def parts_of(level: int, width: int) -> list[int]:
    """Axes of each part of a bucket of so many bits; none for no bits."""
    axes = []
    while level > 0:
        bits = min(level, width.bit_length())
        axes.append(1 << (bits - 1))
        level -= bits
    return axes


def placed(x: np.ndarray, table: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Shelf and leaf, the number on it, of the bucket of each row."""
    shelf = leaf = np.zeros(len(x), np.int64)
    held = 1
    for part, axes in enumerate(parts_of(level, x.shape[1])):
        # The last part is the leaf; those before it name the shelf.
        shelf, held = shelf * held + leaf, 2 * axes
        leaf = turned(x, table, part, axes).argmax(axis=1)
    return shelf, leaf


def probed(x: np.ndarray, table: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shelf, leaf) of the PROBES nearest buckets of each row.

    The nearest buckets begin with the nearest beginnings, so each part keeps no more than PROBES."""
    cost = np.zeros((len(x), 1))
    shelf = leaf = np.zeros((len(x), 1), np.int64)
    held = 1
    for part, axes in enumerate(parts_of(level, x.shape[1])):
        near = turned(x, table, part, axes)
        lacks = (near.max(axis=1, keepdims=True) - near) ** 2
        few = np.argsort(lacks, axis=1, kind="stable")[:, :PROBES]
        sums = (cost[:, :, None] + np.take_along_axis(lacks, few, axis=1)[:, None, :]).reshape(len(x), -1)
        best_few = np.argsort(sums, axis=1, kind="stable")[:, :PROBES]
        cost = np.take_along_axis(sums, best_few, axis=1)
        before, last = best_few // few.shape[1], np.take_along_axis(few, best_few % few.shape[1], axis=1)
        shelf, leaf, held = np.take_along_axis(shelf * held + leaf, before, axis=1), last, 2 * axes
    return np.repeat(np.arange(len(x)), leaf.shape[1]), shelf.ravel(), leaf.ravel()


def on_sphere(x: np.ndarray, longest: np.ndarray, queries: bool) -> np.ndarray:
    """Rows padded to a power of two above their length; the first added component holds what lacks to `longest`, a
    column; queries are brought to unit length instead."""
    wide = np.zeros((len(x), 1 << x.shape[1].bit_length()))
    wide[:, : x.shape[1]] = x / longest
    if not queries:
        wide[:, x.shape[1]] = np.sqrt(np.maximum(0.0, 1.0 - (wide**2).sum(axis=1)))
    return wide


PLACE = "level int, table int, shelf long, leaves array<int>"


def _laid(batch: pa.RecordBatch, at: np.ndarray, level: int, table: int, shelf: np.ndarray, leaves: pa.Array) -> pa.RecordBatch:
    kept = batch.take(pa.array(at))
    place = [pa.array(np.full(len(at), n, np.int32)) for n in (level, table)]
    return pa.RecordBatch.from_arrays(
        [*place, pa.array(shelf), leaves, *kept.columns], names=["level", "table", "shelf", "leaves", *kept.schema.names]
    )


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of components, places and vectors of the rows of each length."""
    lists = batch.column("vector").to_pylist()
    dims = np.array([len(v) for v in lists])
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, np.array([lists[i] for i in at], float)


def _stored_rows(longest: dict[tuple[int, int], float], levels: dict[tuple[int, int], int]):
    """A row for the bucket of every table; both arguments are by number of components and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_length(batch):
                ranges = batch.column("range").to_numpy()[at]
                own = np.array([[longest[dim, int(n)]] for n in ranges])
                level = np.array([levels[dim, int(n)] for n in ranges])
                x = on_sphere(x, own, False)
                for n in np.unique(level):
                    mine = level == n
                    for table in range(TABLES if n else 1):
                        shelf, leaf = placed(x[mine], table, int(n))
                        one = pa.ListArray.from_arrays(np.arange(len(leaf) + 1, dtype=np.int32), leaf.astype(np.int32))
                        yield _laid(batch, at[mine], n, table, shelf, one)

    return run


def _asking_rows(levels: dict[int, list[int]]):
    """A row for every shelf that a query visits, with the leaves it looks at; `levels` are by number of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_length(batch):
                x = on_sphere(x, np.sqrt((x**2).sum(axis=1, keepdims=True)), True)
                for first in range(0, len(x), ASKED):
                    for n in levels[dim]:
                        for table in range(TABLES if n else 1):
                            row, shelf, leaf = probed(x[first : first + ASKED], table, n)
                            order = np.lexsort((leaf, shelf, row))
                            row, shelf, leaf = row[order], shelf[order], leaf[order]
                            new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (shelf[1:] != shelf[:-1])))
                            cuts = np.append(new, len(row)).astype(np.int32)
                            yield _laid(
                                batch, at[first + row[new]], n, table, shelf[new],
                                pa.ListArray.from_arrays(cuts, leaf.astype(np.int32)),
                            )

    return run


def exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of rows side by side in double precision; equal vectors get equal scores wherever they stand."""
    return (queries * data).sum(axis=1)


def pairs_of(asked: np.ndarray, cuts: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) by place, for rows in the order of `leaf`; query n looks at the leaves asked[cuts[n]:cuts[n + 1]].

    Whole queries at a time, so many that there are about PAIRS pairs."""
    start, stop = np.searchsorted(leaf, asked, "left"), np.searchsorted(leaf, asked, "right")
    query = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    upto = np.append(0, np.cumsum(stop - start))[cuts]
    first = 0
    while first < len(cuts) - 1:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + PAIRS, "right")) - 1)
        mine = slice(cuts[first], cuts[last])
        many = (stop - start)[mine]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        yield np.repeat(query[mine], many), np.repeat(start[mine], many) + within
        first = last


def _ranked(k: int):
    """A partition's rows come by shelf, data before queries. Results are kept to the k best of each query now and then."""

    def kept(parts: list[tuple]) -> list[tuple]:
        query_row, query_id, row, vec, score = map(np.concatenate, zip(*parts, strict=True))
        order = np.lexsort((row, vec, -score, query_row))
        query_row, query_id, row, vec, score = (c[order] for c in (query_row, query_id, row, vec, score))
        # A row found in several tables stands next to itself.
        new = np.append(True, (query_row[1:] != query_row[:-1]) | (row[1:] != row[:-1]))
        query_row, query_id, row, vec, score = (c[new] for c in (query_row, query_id, row, vec, score))
        first = np.flatnonzero(np.append(True, query_row[1:] != query_row[:-1]))
        place = np.arange(len(query_row)) - np.repeat(first, np.diff(np.append(first, len(query_row))))
        return [tuple(c[place < k] for c in (query_row, query_id, row, vec, score))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf, data, sorted_, found, held = None, [], False, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("dim", "level", "table", "shelf", "piece", "asks")])
            cuts = np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1)
            for at, end in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
                part = batch.slice(at, end - at)
                rows, ids = part.column("row_id").to_numpy(), part.column("vec_id").to_numpy()
                x = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), -1)
                leaves = part.column("leaves").flatten().to_numpy()
                if not np.array_equal(shelf, keys[at][:5]):
                    shelf, data, sorted_ = keys[at][:5], [], False
                if not keys[at][5]:
                    data.append((rows, ids, x, leaves))
                    continue
                if not data:
                    continue
                if not sorted_:
                    whole = tuple(map(np.concatenate, zip(*data, strict=True)))
                    order = np.argsort(whole[3], kind="stable")
                    data, sorted_ = [tuple(c[order] for c in whole)], True
                rows_in, ids_in, x_in, leaf = data[0]
                spans = np.append(0, np.cumsum(part.column("leaves").value_lengths().to_numpy()))
                for asking, seen in pairs_of(leaves, spans, leaf):
                    other = rows[asking] != rows_in[seen]
                    asking, seen = asking[other], seen[other]
                    if not len(seen):
                        continue
                    scores = exact_scores(x[asking], x_in[seen])
                    found += kept([(rows[asking], ids[asking], rows_in[seen], ids_in[seen], scores)])
                    held += len(found[-1][0])
                    if held > HELD:
                        found = kept(found)
                        held = len(found[0][0])
                        if held > HELD // 2:
                            yield packed(found)
                            found, held = [], 0
        if found:
            yield packed(kept(found))

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in found[0]], names=["query_row", "query_id", "row_id", "vec_id", "score"]
        )

    return run


def nearest(frame: DataFrame, identity: str, vector: str, query: Column, k: int) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): of what the probes find, the k largest inner products."""
    rows = usable(frame, identity, vector, query, F.transform(vector, lambda x: x.cast("double")))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x))
    rows = rows.withColumns({"dim": F.size("vector"), "length": length}).filter("length > 0")
    # One row for each number of components.
    tops = rows.groupBy("dim").agg(F.max("length").alias("top"), (F.count("*") - 1).alias("others"))
    steps = F.log(F.col("top") / F.col("length")) / float(np.log(RATIO))
    rows = rows.join(F.broadcast(tops), "dim").withColumn("range", F.floor(steps + 1e-9).cast("int"))
    ranges = rows.groupBy("dim", "range").agg(F.max("length").alias("longest"), F.count("*").alias("rows")).collect()
    longest = {(r["dim"], r["range"]): r["longest"] for r in ranges}
    levels = {(r["dim"], r["range"]): level_of(r["rows"]) for r in ranges}
    asked = {dim: sorted({n for (d, _), n in levels.items() if d == dim}) for dim, _ in levels}
    columns = ["row_id", "vec_id", "dim", "range", "vector"]
    kind = f"{PLACE}, row_id long, vec_id long, dim int, range int, vector array<double>"
    data = rows.select(columns).mapInArrow(_stored_rows(longest, levels), kind)
    asking = rows.filter("asks")
    asks = asking.select(columns).mapInArrow(_asking_rows(asked), kind)
    once = stored(_searched(data, asks, k), "nearest")
    counts = once.groupBy("query_row").agg(F.count("*").alias("found"))
    short = asking.join(counts, asking["row_id"] == counts["query_row"], "left")
    short = stored(short.filter(F.coalesce("found", F.lit(0)) < F.least(F.lit(k), "others")).select(columns), "nearest-short")
    if not short.isEmpty():
        more = _searched(_everywhere(rows), _everywhere(short), k)
        once = once.join(short.select(F.col("row_id").alias("query_row")), "query_row", "left_anti").unionByName(more)
    return best(once, k, "double")


def _everywhere(rows: DataFrame) -> DataFrame:
    """Rows in one bucket that all queries visit."""
    place = [F.lit(0).alias("level"), F.lit(0).alias("table"), F.lit(0).cast("long").alias("shelf"), F.array(F.lit(0)).alias("leaves")]
    return rows.select(*place, "row_id", "vec_id", "dim", "range", "vector")


def _searched(data: DataFrame, asks: DataFrame, k: int) -> DataFrame:
    """(`query_row`, `query_id`, `row_id`, `vec_id`, `score`): the best of what a query looks at on each shelf, each row once."""
    shelf = ["dim", "level", "table", "shelf"]
    pieces = data.groupBy(*shelf).agg(F.ceil(F.count("*") / PIECE).alias("pieces"))
    data = data.join(pieces, shelf).withColumn("piece", F.pmod(F.xxhash64("row_id"), F.col("pieces")))
    asks = asks.join(pieces, shelf).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    named = [*shelf, "piece", "asks", "row_id", "vec_id", "vector", "leaves"]
    both = data.withColumn("asks", F.lit(0)).select(named).unionByName(asks.withColumn("asks", F.lit(1)).select(named))
    laid = both.repartition(*shelf, "piece").sortWithinPartitions(*shelf, "piece", "asks")
    found = laid.mapInArrow(_ranked(k), "query_row long, query_id long, row_id long, vec_id long, score double")
    return found.groupBy("query_row", "row_id").agg(
        F.first("query_id").alias("query_id"), F.first("vec_id").alias("vec_id"), F.first("score").alias("score")
    ).select("query_row", "query_id", "row_id", "vec_id", "score")
