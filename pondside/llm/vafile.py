"""Exact top-k search with vector-approximation files.

Vectors are dealt to blocks. Of each block a task first scans the quantised cells, a byte for each component: the cell's
middle and half width bound every inner product from above and below. The kth highest lower bound rules out
what cannot be among the k; the exact vectors of the rest are read in the order of their bounds, until the kth
best so far is above every bound to come. A block moves once, to the task that holds it, and the queries come to it one
batch after the other. The first square root of the blocks is searched first; the kth score a query has by then is
its floor in all other blocks, which return no row below it.

Defined results: rows without id, NULL or empty vectors and those with NULL or non-finite components take no part; vectors
meet only those of their own length; repeated rows are candidates like others, and each asks for itself; ties go to
the smaller id; fewer candidates than k give fewer rows; an empty table gives none. Scores are exact while the
products' sum stays within a long; components are whole numbers below 2^53.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import stored
from pondside.llm.vectors import best, usable

BLOCK, LEAST = 65_536, 4_096
CELLS = 16
READ = 256
# Rows whose cells are taken out at a time.
SCANNED = 8_192


class Block:
    """Rows of a block in the order of their ids, so that equal scores come in that order, with their cells."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, data: np.ndarray):
        order = np.lexsort((rows, ids))
        self.rows, self.ids, self.data = rows[order], ids[order], data[order]
        low = self.data.min(axis=0)
        self.width = (self.data.max(axis=0) - low) // CELLS + 1
        self.cells = ((self.data - low) // self.width).astype(np.uint8)
        self.low = low + (self.width - 1) / 2
        self.largest = float(np.abs(self.data).max(initial=0))

    def near(self, queries: np.ndarray) -> np.ndarray:
        """Inner products with the middles of the cells, from the cells alone."""
        scaled = queries * self.width.astype(float)
        out = np.empty((len(queries), len(self.cells)))
        for at in range(0, len(self.cells), SCANNED):
            out[:, at : at + SCANNED] = scaled @ self.cells[at : at + SCANNED].T.astype(float)
        return out + (queries.astype(float) @ self.low)[:, None]


def search_block(block: Block, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> tuple:
    """(query, place, score) of the k highest inner products of each query in a block that are not below its floor; all
    whole numbers but for a floor of minus infinity."""
    data, rows, width = block.data, block.rows, block.width
    out_q, out_r, out_s = [], [], []
    safe = float(np.abs(queries).max(initial=0)) * block.largest * data.shape[1] < 2.0**52
    for at in range(0, len(queries), 64):
        part = queries[at : at + 64]
        near = block.near(part)
        half = np.abs(part) @ ((width - 1) / 2)
        # Room for rounding of the bounds, which matters for huge components only.
        half += 1e-12 * (np.abs(near).max(initial=0) + half)
        for k_, (query, mine, least) in enumerate(zip(part, own[at : at + 64], floors[at : at + 64], strict=True)):
            upper, lower = near[k_] + half[k_], near[k_] - half[k_]
            other = rows != mine
            upper = np.where(other, upper, -np.inf)
            lower = np.where(other, lower, -np.inf)
            floor = np.partition(lower, -k)[-k] if len(lower) > k else -np.inf
            may = np.flatnonzero((upper >= max(floor, least)) & other)
            may = may[np.argsort(-upper[may], kind="stable")]
            seen, scores, kth = np.zeros(0, np.int64), np.zeros(0, np.int64), -np.inf
            for step in range(0, len(may), READ):
                if upper[may[step]] < kth:
                    break
                read = may[step : step + READ]
                exact = data[read].astype(float) @ query.astype(float) if safe else data[read] @ query
                seen, scores = np.append(seen, read), np.append(scores, exact.astype(np.int64))
                order = np.lexsort((seen, -scores))[:k]
                seen, scores = seen[order], scores[order]
                kth = scores[-1] if len(scores) == k else -np.inf
            seen, scores = seen[scores >= least], scores[scores >= least]
            out_q.append(np.full(len(seen), at + k_))
            out_r.append(seen)
            out_s.append(scores)
    return tuple(map(np.concatenate, (out_q, out_r, out_s)))


def _shelves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """A partition's rows come by block, data before queries: each batch of queries with its block."""
    shelf, parts, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(n).to_numpy() for n in ("dim", "block", "turn")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for at, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            part = batch.slice(at, end - at)
            if shelf != tuple(keys[at][:2]):
                shelf, parts, block = tuple(keys[at][:2]), [], None
            if not keys[at][2]:
                parts.append((part.column("row_id").to_numpy(), part.column("vec_id").to_numpy(), _matrix(part)))
                continue
            if parts:
                block, parts = Block(*map(np.concatenate, zip(*parts, strict=True))), []
            if block:
                yield block, part


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    return part.column("vector").flatten().to_numpy().astype(np.int64).reshape(part.num_rows, -1)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, asks in _shelves(batches):
            rows, ids = asks.column("row_id").to_numpy(), asks.column("vec_id").to_numpy()
            floors = np.array([-np.inf if f is None else f for f in asks.column("floor").to_pylist()], object)
            q, r, s = search_block(block, _matrix(asks), rows, floors, k)
            columns = {"query_row": rows[q], "query_id": ids[q], "row_id": block.rows[r], "vec_id": block.ids[r], "score": s}
            yield pa.RecordBatch.from_pydict({name: pa.array(c, pa.int64()) for name, c in columns.items()})

    return run


def _scanned(rows: DataFrame, asks: DataFrame, begin: int, end: int, k: int) -> DataFrame:
    """The best of each query in each of the blocks from `begin` to before `end`."""
    named = ["dim", "block", "turn", "row_id", "vec_id", "vector", "floor"]
    none = F.lit(None).cast("long")
    data = rows.filter(F.col("block").between(begin, end - 1)).withColumns({"turn": F.lit(0), "floor": none})
    every = F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))
    both = data.select(named).unionByName(asks.withColumns({"block": every, "turn": F.lit(1)}).select(named))
    laid = both.repartition(end - begin, "dim", "block").sortWithinPartitions("dim", "block", "turn")
    return laid.mapInArrow(_search(k), "query_row long, query_id long, row_id long, vec_id long, score long")


def top_k(frame: DataFrame, identity: str, vector: str, query: Column, scale: float, k: int) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): the k highest inner products of the scaled, floored vectors."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = usable(frame, identity, vector, query, whole)
    count = rows.count()
    # Small tables are spread over the cores, in blocks of LEAST rows or more.
    idle = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST))
    blocks = max(1, math.ceil(count / BLOCK), idle)
    place = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int")
    rows = rows.withColumns({"dim": F.size("vector"), "block": place})
    asks = rows.filter("asks").drop("block").withColumn("floor", F.lit(None).cast("long"))
    first = math.isqrt(blocks - 1) + 1
    found = _scanned(rows, asks, 0, first, k)
    if first < blocks:
        found = stored(found, "vafile-first")
        order = Window.partitionBy("query_row").orderBy(F.col("score").desc())
        kth = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") == k)
        kth = kth.select(F.col("query_row").alias("row_id"), F.col("score").alias("floor"))
        found = found.unionByName(_scanned(rows, asks.drop("floor").join(kth, "row_id", "left"), first, blocks, k))
    return best(found, k, "long")
