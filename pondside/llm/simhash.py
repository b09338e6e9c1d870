"""SimHash near-dedup with BK-trees.

A fingerprint holds the majority bit of the hashes of a text's shingles. Equal fingerprints are one key, so copies
cost nothing more. Two keys within `bits` differing bits agree on at least one of `bits` + 1 bands; the keys that
share a band's value form a shard, and each shard has a BK-tree: children hang on their Hamming distance to the
parent, and a search follows only edges whose distance is within the radius of its own. A shard of more
than PIECE keys is cut by hash, and every two of its pieces meet in a tree of their own. What a tree gives is
one link from each key to the smallest key it reaches there, never all pairs. Links make components.

A tree goes to one task with its shard, instead of all trees to every executor: they grow with the data.

Defined results: NULL, empty and blank texts have fingerprint zero and are linked like any others; texts of fewer
words than a shingle have one shingle; rows without doc_id are fingerprinted and linked, but name no
component unless all of it has none; an empty table gives no rows. Only the columns asked for are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pondside.llm.common import small_batches, stored
from pondside.llm.components import components

SEED = 42
PIECE = 8192
_BITS = 64


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the shingles' hashes, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(1, len(words) - shingle + 1)
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(joined(words[i : i + shingle]), SEED) for i in range(last)), np.uint64, last)
    ones = np.zeros(_BITS, np.int64)
    for at in range(0, last, 65_536):
        part = np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += part.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str, shingle: int, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` (else all) in `row`, with the fingerprint `fp` as a signed long."""
    small_batches(docs.sparkSession)
    keep = keep or docs.columns
    kind = docs.select(*keep).schema.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(signed)], names=["row", "fp"])

    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row {kind}, fp long")


def tree_links(keys: np.ndarray, bits: int) -> np.ndarray:
    """For each key the position of the smallest key that it reaches over steps of at most `bits` bits.

    Builds the BK-tree of the sorted keys from the top and sends all searches through it together: what is
    in a subtree is the keys at one distance from its parent, its root the first of them.
    """
    parent = np.arange(len(keys))

    def roots(at: np.ndarray) -> np.ndarray:
        at = parent[at]
        while True:
            up = parent[at]
            if np.array_equal(up, at):
                return at
            at = up

    everyone = np.arange(len(keys))
    stack = [(everyone, everyone)]
    while stack:
        members, searches = stack.pop()
        root = members[0]
        far = np.bitwise_count(keys[searches] ^ keys[root])
        near = searches[far <= bits]
        if len(near) > 1 or (len(near) and near[0] != root):
            tops = roots(np.append(near, root))
            parent[tops] = tops.min()
        below = members[1:]
        if not len(below):
            continue
        edges = np.bitwise_count(keys[below] ^ keys[root])
        for edge in np.unique(edges):
            asked = searches[(far >= max(0, int(edge) - bits)) & (far <= edge + bits)]
            if len(asked):
                stack.append((below[edges == edge], asked))
    return roots(everyone)


def _shard_links(bits: int):
    def linked(keys: np.ndarray) -> pa.RecordBatch:
        keys = np.unique(keys)
        to = tree_links(keys.view(np.uint64), bits)
        own = np.flatnonzero(to != np.arange(len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(keys[to[own]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a shard follow each other, over batches too."""
        open_shard, open_keys = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            shards = np.column_stack([batch.column(n).to_numpy() for n in ("band", "value", "i", "j")])
            keys = batch.column("fp").to_numpy()
            starts = np.flatnonzero((shards[1:] != shards[:-1]).any(axis=1)) + 1
            made = []
            for part, head in zip(np.split(keys, starts), shards[np.append(0, starts)], strict=True):
                if open_keys and not np.array_equal(head, open_shard):
                    made.append(linked(np.concatenate(open_keys)))
                    open_keys = []
                open_shard = head
                open_keys.append(part)
            yield from made
        if open_keys:
            yield linked(np.concatenate(open_keys))

    return run


def links(keys: DataFrame, bits: int) -> DataFrame:
    """Links (`u`, `v`) that connect all keys `fp` within `bits` differing bits, directly or through others."""
    width = -(-_BITS // (bits + 1))
    bands = F.array(
        *(
            F.struct(
                F.lit(b).alias("band"),
                F.shiftrightunsigned("fp", b * width).bitwiseAND((1 << min(width, _BITS - b * width)) - 1).alias("value"),
            )
            for b in range(bits + 1)
        )
    )
    banded = keys.select("fp", F.inline(bands))
    sizes = banded.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("n") / PIECE)
    meet = banded.join(sizes, ["band", "value"]).withColumn("piece", F.pmod(F.xxhash64("fp"), pieces))
    meet = meet.select(
        "band", "value", "fp", "piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("other")
    ).select("band", "value", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"), "fp")
    shard = ["band", "value", "i", "j"]
    return meet.repartition(*shard).sortWithinPartitions(*shard).mapInArrow(_shard_links(bits), "u long, v long")


def near_duplicates(prints: DataFrame, identity: str, bits: int) -> DataFrame:
    """For each fingerprint `fp` its `group`, the smallest fingerprint of the component, and `component_id`, the
    smallest id. `prints` has `fp` and the id, one row per document."""
    keys = stored(prints.groupBy("fp").agg(F.min(identity).alias("first_id")), "fingerprint-keys")
    parts = components(links(keys, bits)).select(F.col("u").alias("fp"), F.col("v").alias("group"))
    grouped = keys.join(parts, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    names = grouped.groupBy("group").agg(F.min("first_id").alias("component_id"))
    return grouped.join(names, "group").select("fp", "group", "component_id")


def first_of_each(docs: DataFrame, identity: str, text: str, shingle: int, bits: int) -> DataFrame:
    """The row of the smallest id of each component, with all its columns; of several rows of that id the one whose text
    has the smallest hash, once."""
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(identity).alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"),
        F.col(text).alias("text"),
    )
    printed = fingerprints(rows, "text", shingle, ["id", "digest"])
    prints = stored(printed.select("row.id", "row.digest", "fp"), "fingerprints")
    mine = prints.join(near_duplicates(prints, "id", bits), "fp").filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = mine.groupBy("group").agg(F.first("component_id").alias("chosen_id"), F.min("digest").alias("chosen"))
    same = F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("digest") == F.col("chosen"))
    return rows.join(chosen, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")
