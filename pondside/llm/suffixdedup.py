"""Removal of repeated byte strings, by passes over windows as in the merge of Burrows-Wheeler transforms.

Every window of WINDOW bytes belongs to its anchor, the place in it whose GRAM bytes hash lowest (the first of
several). Consecutive windows of one anchor form a piece. Equal windows have equal anchors at equal places, so
they meet when pieces are dealt by the anchor's bytes. Equal pieces are one class, counted before anything is
shuffled; a class met twice is repeated as a whole, and only anchors with several classes need their bytes.

There the classes' windows are merged, all at once; no transform of a shard is built or merged with another. Windows are kept in the
order of what is read so far, with the bounds of blocks that share it. Each round reads the next symbol, SYMBOL bytes further to
the front from the window's end, and orders by it alone, stably. A bound falls where symbol or former block changes; lengths of
common prefixes are not kept. Windows alone in their block are settled and leave. Blocks left when WINDOW bytes are read are
the repeated intervals.

An anchor at the edge of a passage that very many texts hold has as many classes as contexts, more windows than one
task should merge. Beyond `together` windows its rounds are not run one by one: the block of a window is the hash of all
its bytes, and a block that two classes share is a repeated interval. Blocks are dealt by anchor and hash and reduced before
they are shuffled, so no task holds an anchor whole.

Defined results: a NULL text is empty; texts shorter than a window lose nothing; equal rows are repeats of
each other; rows without id keep a NULL id; an empty table gives no rows. Only the columns asked for are read. `docs`
must be a table that is read alike twice, as files are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pondside.llm.common import stored

WINDOW = 200
GRAM = 16
SYMBOL = 2
# Windows merged at a time; an anchor that alone has more is dealt by its windows.
TOGETHER = 1_000_000
# A class with a larger share of all pieces is hot, so that at most 100,000 are.
HOT_SHARE = 1e-5
_PLACE_BITS = 28
_STRETCH = 1 << 26


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    wide = np.lib.stride_tricks.sliding_window_view(data, 8)
    eight = np.ascontiguousarray(wide).view(np.uint64).ravel()
    x = eight[: len(data) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)
    x ^= np.roll(eight, -8)[: len(x)] * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchored(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each piece, and the hash of its anchor."""
    firsts, lasts, keys = [], [], []
    for at in range(0, max(0, len(data) - WINDOW + 1), _STRETCH):
        part = data[at : at + _STRETCH + WINDOW - 1]
        hashes = gram_hashes(part)
        ranked = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
        anchors = window_minima(ranked, WINDOW - GRAM + 1) & np.uint64((1 << _PLACE_BITS) - 1)
        first = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
        firsts.append(first + at)
        lasts.append(np.append(first[1:], len(anchors)) - 1 + at)
        keys.append(hashes[anchors[first].astype(np.int64)])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(keys)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for place, text in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = _bytes(text)
            first, last, key = anchored(np.frombuffer(raw, np.uint8))
            if not len(first):
                continue
            ends = last + WINDOW
            content = np.fromiter((digest(raw[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)), np.uint64, len(first))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array(key.view(np.int64)),
                    "content": pa.array(content.view(np.int64)),
                    "place": pa.array(np.full(len(first), place, np.int64)),
                    "first": pa.array(first.astype(np.int32)),
                    "windows": pa.array((last - first + 1).astype(np.int32)),
                }
            )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the pieces wanted of each text."""
    for batch in batches:
        for row in batch.to_pylist():
            raw, wanted = _bytes(row["text"]), row["wanted"]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([w["key"] for w in wanted], pa.int64()),
                    "content": pa.array([w["content"] for w in wanted], pa.int64()),
                    "piece": pa.array([raw[w["first"] : w["first"] + w["windows"] + WINDOW - 1] for w in wanted], pa.binary()),
                }
            )


def _cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every window of the pieces wanted of each text."""
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for row in batch.to_pylist():
            raw = _bytes(row["text"])
            for w in row["wanted"]:
                count = w["windows"]
                block = np.fromiter((digest(raw[a : a + WINDOW]) for a in range(w["first"], w["first"] + count)), np.uint64, count)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(np.full(count, w["key"], np.int64)),
                        "content": pa.array(np.full(count, w["content"], np.int64)),
                        "number": pa.array(np.arange(count, dtype=np.int32)),
                        "block": pa.array(block.view(np.int64)),
                    }
                )


def repeated_windows(pieces: list[bytes], keys: np.ndarray) -> list[np.ndarray]:
    """Numbers of the windows of each piece that occur in another piece of its key as well."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    windows = sizes - WINDOW + 1
    owner = np.repeat(np.arange(len(pieces)), windows)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    ends = starts[owner] + number + WINDOW
    # In the order of the key to begin with: blocks are the keys.
    order = np.argsort(keys[owner], kind="stable")
    at, who = ends[order], order
    block = np.cumsum(np.append(0, keys[owner][order][1:] != keys[owner][order][:-1]))
    wide = np.lib.stride_tricks.sliding_window_view(text, SYMBOL)
    symbols = np.ascontiguousarray(wide).view(np.uint16).ravel()
    for _ in range(WINDOW // SYMBOL):
        if not len(at):
            break
        at = at - SYMBOL
        symbol = symbols[at]
        order = np.argsort(symbol, kind="stable")
        at, who, symbol, block = at[order], who[order], symbol[order], block[order]
        bound = np.append(True, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))
        alone = bound & np.append(bound[1:], True)
        block = np.cumsum(bound)
        if alone.any():
            keep = ~alone
            at, who, block = at[keep], who[keep], block[keep]
    left = np.sort(who)
    return np.split(number[left], np.searchsorted(owner[left], np.arange(1, len(pieces))))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by key. Whole keys are merged, some together."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def found(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        numbers = repeated_windows([p for _, _, p in rows], np.array([k for k, _, _ in rows], np.int64))
        runs = []
        for n in numbers:
            cuts = np.flatnonzero(np.diff(n) > 1) + 1
            runs.append([{"a": int(r[0]), "b": int(r[-1])} for r in np.split(n, cuts) if len(r)])
        kept = [k for k, r in enumerate(runs) if r]
        return pa.RecordBatch.from_pydict(
            {
                "key": pa.array([rows[k][0] for k in kept], pa.int64()),
                "content": pa.array([rows[k][1] for k in kept], pa.int64()),
                "runs": pa.array([runs[k] for k in kept], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
            }
        )

    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("key", "content", "piece")), strict=True):
            if size > TOGETHER and row[0] != held[-1][0]:
                yield found(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2]) - WINDOW + 1
    if held:
        yield found(held)


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, and the maximal runs removed."""
    for batch in batches:
        kept, spans, sizes = [], [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
            raw, out, gone = _bytes(text), [], []
            for run in sorted(runs or (), key=lambda r: r["begin"]):
                if gone and run["begin"] <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], run["end"])
                else:
                    gone.append([run["begin"], run["end"]])
            at = 0
            for begin, end in gone:
                out.append(raw[at:begin])
                at = end
            out.append(raw[at:])
            kept.append(b"".join(out))
            sizes.append(len(raw))
            spans.append([{"begin": b, "end": e} for b, e in gone])
        span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["id", "bytes", "spans", "kept"],
        )


def _runs_of_blocks(windows: DataFrame) -> DataFrame:
    """(`key`, `content`, `runs`) of the windows whose block another class of the anchor shares.

    A class has at most WINDOW - GRAM + 1 windows, so what is collected of one is bounded."""
    shared = windows.groupBy("key", "block").agg(F.min("content").alias("a"), F.max("content").alias("b")).filter("a != b")
    found = windows.join(shared.select("key", "block"), ["key", "block"])
    numbers = found.groupBy("key", "content").agg(F.array_sort(F.collect_list("number")).alias("n"))
    begins = F.filter("n", lambda x: ~F.array_contains("n", x - 1))
    ends = F.filter("n", lambda x: ~F.array_contains("n", x + 1))
    return numbers.select("key", "content", F.arrays_zip(begins, ends).cast("array<struct<a:int,b:int>>").alias("runs"))


def without_repeats(docs: DataFrame, identity: str, text: str, together: int = TOGETHER) -> DataFrame:
    """(`id`, `bytes`, `spans`, `kept`): size of each text, its removed runs, and the bytes left."""
    placed = docs.select(F.monotonically_increasing_id().alias("place"), F.col(identity).alias("id"), F.col(text).alias("text"))
    pieces = placed.select("place", "text").mapInArrow(_pieces, "key long, content long, place long, first int, windows int")
    pieces = stored(pieces, "suffix-pieces")
    classes = pieces.groupBy("key", "content").agg(
        F.count("*").alias("times"), F.min("place").alias("place"), F.first("windows").alias("windows")
    )
    classes = stored(classes, "suffix-classes")
    several = classes.groupBy("key").agg(
        F.min("content").alias("a"), F.max("content").alias("b"), (F.sum("windows") > together).alias("hot")
    )
    several = several.filter("a != b").select("key", "hot")
    wanted = classes.join(several, "key").select("key", "content", "place", "hot")
    where = pieces.join(wanted, ["key", "content", "place"]).groupBy("hot", "key", "content", "place").agg(
        F.min("first").alias("first"), F.first("windows").alias("windows")
    )
    where = where.groupBy("hot", "place").agg(F.collect_list(F.struct("key", "content", "first", "windows")).alias("wanted"))
    where = stored(where, "suffix-wanted")

    def texts(hot: bool) -> DataFrame:
        named = where.filter(F.col("hot") == hot).select("place", "wanted")
        return placed.select("place", "text").join(named, "place").select("text", "wanted")

    cut = texts(False).mapInArrow(_cut_out, "key long, content long, piece binary")
    runs = cut.repartition("key").sortWithinPartitions("key").mapInArrow(
        _merged, "key long, content long, runs array<struct<a:int,b:int>>"
    )
    if not where.filter("hot").isEmpty():
        windows = stored(texts(True).mapInArrow(_cut_windows, "key long, content long, number int, block long"), "suffix-blocks")
        runs = runs.unionByName(_runs_of_blocks(windows))
    runs = stored(runs, "suffix-runs")
    # A class met twice is repeated from its first window to its last. Pieces of hot classes stay where they are: each such
    # class is met twice, and its two numbers are sent to every executor.
    many = F.greatest(F.lit(1), F.lit(HOT_SHARE) * (classes.agg(F.sum("times")).first()[0] or 0))
    hot = F.broadcast(classes.filter(F.col("times") > many).select("key", "content"))
    known = classes.join(runs, ["key", "content"], "left").filter("times > 1 or runs is not null").filter(F.col("times") <= many)
    others = pieces.join(hot, ["key", "content"], "left_anti").join(known.select("key", "content", "times", "runs"), ["key", "content"])
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("windows") - 1).alias("b")))
    copied = pieces.join(hot, ["key", "content"]).select("place", "first", whole[0].alias("run"))
    run = F.explode(F.when(F.col("times") > 1, whole).otherwise(F.col("runs")))
    found = others.select("place", "first", run.alias("run")).unionByName(copied)
    found = found.select(
        "place",
        F.struct((F.col("first") + F.col("run.a")).alias("begin"), (F.col("first") + F.col("run.b") + WINDOW).alias("end")).alias("run"),
    )
    gone = stored(found.groupBy("place").agg(F.collect_list("run").alias("runs")), "suffix-gone")
    joined = placed.join(gone, "place", "left").select("id", "text", "runs")
    kind = docs.schema[identity].dataType.simpleString()
    return joined.mapInArrow(_rest, f"id {kind}, bytes long, spans array<struct<begin:int,end:int>>, kept binary")
