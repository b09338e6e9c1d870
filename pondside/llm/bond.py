"""Hard-negative mining with a vertical scan (BOND) of blocks of vectors.

A block keeps its vectors by dimension. For an anchor, the dimensions are read in descending order of the anchor's magnitude;
what has been read gives a partial inner product of every row left, and the block's smallest and largest component of each
dimension bound what the others can still add. Every STEP dimensions the bitmap of candidates is cut to the rows whose bounds
leave them a place in the result; those that remain are read to the end, so their scores are exact.

There are two scans. The first finds each anchor's positives, its best rows of the same label. Each positive's score is
the top of a window of scores; the second scan finds the best rows of other labels inside each window. Both look at some square
root of the blocks first: what an anchor finds there bounds its result from below in all other blocks, so those pass on
little. Rows go to their block once a scan, by a hash; anchors, a stated share of the rows, go to every block.

Defined results: rows without id or label, NULL or empty vectors and those with NULL or non-finite components take no
part; vectors meet only those of their own length; repeated rows are candidates like others, and each is an anchor for itself; ties go
to the smaller id; fewer rows than asked for are all returned, and a positive without a negative in its window has no row; an
empty table gives none. Other columns are not read. Scores are exact while the products' sum stays within a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import stored

# Rows of a block, and of one where that leaves tasks idle.
BLOCK, LEAST = 65_536, 4_096
STEP = 8
FOUND = "anchor_row long, positive int, row_id long, vec_id long, score long"


@dataclass
class Block:
    """Vectors in the order of label, id and row; `columns` has a row for each dimension, `low` and `high` its bounds."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Block:
        order = np.lexsort((rows, ids, labels))
        columns = np.ascontiguousarray(vectors[order].T)
        return cls(rows[order], ids[order], labels[order], columns, columns.min(axis=1), columns.max(axis=1))

    def of_label(self, label: int) -> tuple[int, int]:
        """The places of a label's rows: begin and end."""
        begin, end = np.searchsorted(self.labels, [label, label + 1])
        return int(begin), int(end)

    def scan(self, anchor: np.ndarray, at: np.ndarray, stay: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Those of the places `at` that are left, with their exact scores. `stay` gets lower and upper bounds of the scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least, most = (np.append(np.cumsum(x[::-1])[::-1], 0) for x in (ends.min(axis=0), ends.max(axis=0)))
        sums = np.zeros(len(at), np.int64)
        for step in range(0, len(order), STEP):
            for dimension in order[step : step + STEP]:
                sums += anchor[dimension] * self.columns[dimension][at]
            read = step + STEP
            if read >= len(order) or not len(at):
                break
            bitmap = stay(sums + least[read], sums + most[read])
            at, sums = at[bitmap], sums[bitmap]
        return at, sums

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k highest, ties by id and row."""
        if len(at) > k:
            high = scores >= np.partition(scores, -k)[-k]
            at, scores = at[high], scores[high]
        order = np.lexsort((self.rows[at], self.ids[at], -scores))[:k]
        return at[order], scores[order]


def _kth(scores: np.ndarray, k: int, floor: int) -> int:
    return max(floor, int(np.partition(scores, -k)[-k])) if len(scores) >= k else floor


def positives(block: Block, anchor: np.ndarray, row: int, label: int, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best rows of the anchor's label that score at least `floor`, itself left out."""
    at = np.arange(*block.of_label(label))
    at = at[block.rows[at] != row]
    at, scores = block.scan(anchor, at, lambda lower, upper: upper >= _kth(lower, k, floor))
    return block.best(at[scores >= floor], scores[scores >= floor], k)


def negatives(block: Block, anchor: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of scores, both ends included, places and scores of its k best rows of other labels."""
    begin, end = block.of_label(label)
    at = np.append(np.arange(begin), np.arange(end, len(block.ids)))

    def stay(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        bitmap = np.zeros(len(lower), bool)
        for low, high in windows:
            surely = (lower >= low) & (upper <= high)
            bitmap |= (upper >= _kth(lower[surely], k, low)) & (lower <= high)
        return bitmap

    at, scores = block.scan(anchor, at, stay)
    inside = [(scores >= low) & (scores <= high) for low, high in windows]
    return [block.best(at[x], scores[x], k) for x in inside]


def _shelves(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch]]:
    """Each block of a partition with the anchors that follow it, some of them at a time."""
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
                parts.append([*(part.column(n).to_numpy() for n in ("row_id", "vec_id", "label")), _matrix(part)])
                continue
            if parts:
                block, parts = Block.of(*map(np.concatenate, zip(*parts, strict=True))), []
            if block:
                yield block, part


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    return part.column("vector").flatten().to_numpy().astype(np.int64).reshape(part.num_rows, -1)


def _batch(found: list[tuple]) -> pa.RecordBatch:
    names = ["anchor_row", "positive", "row_id", "vec_id", "score"]
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _with_positives(k: int) -> Callable:
    def run(batches):
        for block, asks in _shelves(batches):
            found = []
            rest = (asks.column(n).to_pylist() for n in ("row_id", "label", "floors"))
            for anchor, row, label, floors in zip(_matrix(asks), *rest, strict=True):
                floor = floors[0] if floors and floors[0] is not None else np.iinfo(np.int64).min
                at, scores = positives(block, anchor, row, label, floor, k)
                found.append((np.full(len(at), row), np.zeros(len(at), int), block.rows[at], block.ids[at], scores))
            yield _batch(found)

    return run


def _with_negatives(k: int) -> Callable:
    def run(batches):
        for block, asks in _shelves(batches):
            found = []
            rest = (asks.column(n).to_pylist() for n in ("row_id", "label", "lows", "highs", "floors"))
            for anchor, row, label, lows, highs, floors in zip(_matrix(asks), *rest, strict=True):
                cut = [low if floor is None else max(low, floor) for low, floor in zip(lows, floors, strict=True)]
                for n, (at, scores) in enumerate(negatives(block, anchor, label, list(zip(cut, highs, strict=True)), k)):
                    found.append((np.full(len(at), row), np.full(len(at), n + 1), block.rows[at], block.ids[at], scores))
            if found:
                yield _batch(found)

    return run


def _scanned(rows: DataFrame, asks: DataFrame, search: Callable, begin: int, end: int) -> DataFrame:
    """What the anchors find in the blocks from `begin` to before `end`, by partial results."""
    data = rows.filter(F.col("block").between(begin, end - 1)).withColumn("turn", F.lit(0))
    every = F.explode(F.sequence(F.lit(begin), F.lit(end - 1)))
    asks = asks.withColumns({"block": every, "turn": F.lit(1)})
    both = data.unionByName(asks, allowMissingColumns=True)
    laid = both.repartition(end - begin, "dim", "block").sortWithinPartitions("dim", "block", "turn")
    return laid.mapInArrow(search, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and positive, with `rank` from 1."""
    order = Window.partitionBy("anchor_row", "positive").orderBy(F.col("score").desc(), "vec_id", "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(rows: DataFrame, asks: DataFrame, search: Callable, blocks: int, k: int, name: str) -> DataFrame:
    """The k best of each anchor and positive: some blocks first, then the others with the floors found there. `asks` has
    `positives`, how many floors there are."""
    first = math.isqrt(blocks - 1) + 1
    none = F.array_repeat(F.lit(None).cast("long"), F.col("positives"))
    found = _scanned(rows, asks.withColumn("floors", none), search, 0, first)
    best = stored(_ranked(found, k), f"{name}-first")
    if first == blocks:
        return best
    full = best.filter(F.col("rank") == k).groupBy(F.col("anchor_row").alias("row_id"))
    full = full.agg(F.map_from_entries(F.collect_list(F.struct("positive", "score"))).alias("full"))
    # The one list of the first scan is numbered 0, the windows of the second from 1 on.
    number = F.sequence(F.col("begins"), F.col("begins") + F.col("positives") - 1)
    floors = F.transform(number, lambda n: F.try_element_at("full", n))
    asks = asks.join(full, "row_id", "left").withColumn("floors", floors).drop("full")
    more = _scanned(rows, asks, search, first, blocks)
    return stored(_ranked(best.drop("rank").unionByName(more), k), f"{name}-all")


def hard_negatives(
    frame: DataFrame, identity: str, vector: str, label: Column, anchor: Column, scale: float,
    positive: int = 5, negative: int = 5, lowest: int = 80, highest: int = 100,
) -> DataFrame:
    """(`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`) for each anchor, its `positive` best rows
    of the same label, and for each of those the `negative` best rows of other labels that score `lowest` to `highest` percent of
    it. Scores are inner products of the scaled, floored vectors; `label` is a whole number."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    fine = F.col(identity).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = frame.filter(fine & F.coalesce(finite, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(identity).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("asks"),
        F.size(vector).alias("dim"),
        whole.alias("vector"),
    )
    rows = stored(rows, "bond-rows")
    count = rows.count()
    idle = min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST))
    blocks = max(1, math.ceil(count / BLOCK), idle)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int"))
    asking = rows.filter("asks").select("row_id", "vec_id", "label", "dim", "vector")
    rows = rows.drop("asks")
    one = asking.withColumns({"begins": F.lit(0), "positives": F.lit(1)})
    same = _searched(rows, one, _with_positives(positive), blocks, positive, "bond-positives")
    entry = F.struct("rank", F.col("vec_id").alias("id"), "score")
    listed = same.groupBy(F.col("anchor_row").alias("row_id")).agg(F.array_sort(F.collect_list(entry)).alias("same"))
    low = F.transform("same", lambda p: F.ceil(p["score"] * lowest / F.lit(100).cast("decimal(3,0)")).cast("long"))
    high = F.transform("same", lambda p: F.floor(p["score"] * highest / F.lit(100).cast("decimal(3,0)")).cast("long"))
    windows = {"lows": low, "highs": high, "begins": F.lit(1), "positives": F.size("same")}
    asks = asking.join(listed, "row_id").withColumns(windows)
    found = _searched(rows, asks.drop("same"), _with_negatives(negative), blocks, negative, "bond-negatives")
    named = asks.select(F.col("row_id").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), "same")
    positive_at = F.element_at("same", F.col("positive"))
    return found.join(named, "anchor_row").select(
        "anchor_id",
        positive_at["id"].alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        positive_at["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
