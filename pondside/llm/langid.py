"""Language identification by words first, with backoff to character n-grams.

A word of the model scores its log frequency in each language. A word not in it is read from left to right: the
longest n-gram known at a place scores its own log frequency, and the next place follows one letter on. A text's scores are the
sums over its words; the prediction is the largest, the score its share after softmax.

Counts cover all documents learned from, every word, n-gram and language of them. They are stored tables, to which the words of
the texts are joined. The up to CACHED most frequent words are sent to every executor besides, so that only rarer ones take
part in the join; results do not depend on it. Log frequencies are counted in units of 1 / UNIT, so that sums come out alike in any order.

Defined results: a NULL text or one without a letter is `und` with score 0; rows without a language teach
nothing; ties go to the language with more words learned, then by name; with nothing to learn from all are `und`;
an empty table gives no rows; texts and words of any length are read whole, in time that grows with them; equal rows get equal
results. Only the columns asked for are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pondside.llm.common import let, removed, stored

LONGEST = 4
# Letters of a word whose n-grams are made together; longer words are cut, and a hash stands for them.
CHUNK = 256
SMOOTH = 0.5
UNIT = 1 << 32
# Words sent to every executor, fewer where there are so many languages that they would be more than CELLS numbers.
CACHED, CELLS = 200_000, 12_000_000
# Up to so many n-grams are sent to every executor; words of the texts that are too common for a join's task.
SENT_GRAMS, COMMON = 200_000, 1000
# Texts of a batch turned into Python strings at a time, and entries counted before they are passed on.
TEXTS, COUNTED = 256, 400_000
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows of each batch at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


@dataclass
class Model:
    """What is added to a language's score by each word (`words`) or n-gram (`grams`) it has is a table of (`k`, `x`) entries: the
    language's place in `langs`, and units above what an unseen one adds. That is in `base`, by kind: words, then n-grams of each
    length; entries with k = -1 - kind say how often it counts. `cached` holds the rows of frequent words in `table`."""

    langs: list[str]
    words: DataFrame | None = None
    grams: DataFrame | None = None
    base: np.ndarray | None = None
    cached: dict[str, int] | None = None
    table: np.ndarray | None = None


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language, summed until there are COUNTED."""

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, counter in counts.items():
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(counter), pa.string()),
                    "word": pa.array(counter.keys(), pa.string()),
                    "n": pa.array(counter.values(), pa.int64()),
                }
            )
        counts.clear()

    counts: dict[str, Counter] = {}
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words(text))
        if sum(map(len, counts.values())) > COUNTED:
            yield from flushed()
    yield from flushed()


def _entries(counts: DataFrame, unit: str, langs: DataFrame) -> DataFrame:
    """(`unit`, `total`, `entries`) of (`unit`, `lang`, `n`)."""
    above = F.round((F.log(F.col("n") + SMOOTH) - math.log(SMOOTH)) * UNIT).cast("long")
    entry = F.struct("k", above.alias("x"))
    return counts.join(F.broadcast(langs), "lang").groupBy(unit).agg(F.sum("n").alias("total"), F.collect_list(entry).alias("entries"))


def train(docs: DataFrame, text: str, lang: str) -> Model:
    """A model of the documents that have a language. One row for each language passes the driver, and the cached words."""
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counted, "lang string, word string, n long")
    counts = stored(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words", compression="zstd")
    sizes = range(1, LONGEST + 1)
    room = [F.sum(F.col("n") * F.greatest(F.length("word") + 3 - size, F.lit(0))).alias(f"g{size}") for size in sizes]
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"), *room).orderBy(F.col("n").desc(), "lang").collect()
    langs = [r["lang"] for r in totals]
    if not langs:
        return Model([])
    places = docs.sparkSession.createDataFrame(list(enumerate(langs)), "k int, lang string")
    units = stored(_entries(counts, "word", places), "langid-vectors", compression="zstd")
    parts = counts.select("lang", "n", F.explode(_chunks(F.col("word"))).alias("chunk"))

    def cut(size):
        # The function takes one argument: a second one would be given the place in the array.
        last = F.least(F.lit(CHUNK), F.length("chunk") + 1 - size)
        every = F.transform(F.sequence(F.lit(1), last), lambda i: F.col("chunk").substr(i, F.lit(size)))
        return F.when(last >= 1, every).otherwise(F.array().cast("array<string>"))

    grams = parts.select("lang", "n", F.explode(F.concat(*map(cut, sizes))).alias("gram")).groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    grams = stored(_entries(grams, "gram", places), "langid-grams", compression="zstd")
    removed(counts)
    known = {r["size"]: r["count"] for r in grams.groupBy(F.length("gram").alias("size")).count().collect()}
    known[0] = units.count()
    room = np.array([[r["n"], *(r[f"g{size}"] for size in sizes)] for r in totals], float).T
    many = np.array([[max(1, known.get(kind, 0))] for kind in range(LONGEST + 1)])
    base = math.log(SMOOTH) - np.log(room + SMOOTH * many)
    often = units.orderBy(F.col("total").desc(), "word").limit(min(CACHED, CELLS // len(langs)))
    often = often.select("word", "entries").toArrow()
    entries = often.column("entries").combine_chunks()
    table = np.zeros((often.num_rows, len(langs)))
    if often.num_rows:
        flat, size = entries.flatten(), np.diff(entries.offsets.to_numpy())
        table[np.repeat(np.arange(often.num_rows), size), flat.field("k").to_numpy()] = flat.field("x").to_numpy()
    cached = {word: k for k, word in enumerate(often.column("word").to_pylist())}
    return Model(langs, units, grams, base, cached, table)


def _chunks(word: Column) -> Column:
    """The word between two blanks, cut into parts of CHUNK letters; each has the letters behind it that an n-gram may reach to."""
    starts = F.sequence(F.lit(1), F.length(word) + 2, F.lit(CHUNK))
    return let(
        F.concat(F.lit(" "), word, F.lit(" ")),
        lambda padded: F.transform(starts, lambda at: padded.substr(at, F.lit(CHUNK + LONGEST - 1))),
    )


def _key(word: Column) -> Column:
    """What stands for a word in joins and groups: itself, or a hash of a very long one."""
    return F.when(F.length(word) > CHUNK, F.concat(F.lit("#"), F.sha2(word, 256))).otherwise(word)


def _backed_off(unseen: DataFrame, grams: DataFrame) -> DataFrame:
    """(`key`, `entries`): the mean over the places of each word, of the longest n-gram known at each."""
    few = grams.count() <= SENT_GRAMS
    grams = F.broadcast(grams) if few else grams
    parts = unseen.select(_key(F.col("word")).alias("key"), F.posexplode(_chunks(F.col("word"))).alias("part", "chunk"))
    # The blank behind a word is no place of its own; it ends the last part, which is less than a full one.
    last = F.least(F.lit(CHUNK), F.length("chunk") - F.when(F.length("chunk") < CHUNK + LONGEST - 1, 1).otherwise(0))
    places = parts.filter(last >= 1).select("key", "part", "chunk", F.explode(F.sequence(F.lit(1), last)).alias("at"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("chunk") + 1 - F.col("at")))
    tried = places.select("key", "part", "chunk", "at", F.explode(sizes).alias("size"))
    gram = F.col("chunk").substr(F.col("at"), F.col("size"))
    own = ["key", "part", "chunk", "at"]
    longest = tried.withColumn("gram", gram).join(grams.select("gram"), "gram", "left_semi").groupBy(own).agg(F.max("size").alias("size"))
    longest = longest.select("key", "size", gram.alias("gram"))
    # Where n-grams are sent, the places of a word meet before they take a row for each language.
    found = (longest.repartition("key") if few else longest).join(grams, "gram")
    counted = F.array(F.struct((-1 - F.col("size")).alias("k"), F.lit(UNIT).alias("x")))
    sums = found.select("key", F.inline(F.concat(counted, "entries"))).groupBy("key", "k").agg(F.sum("x").alias("x"))
    sums = sums.groupBy("key").agg(
        F.collect_list(F.struct("k", "x")).alias("entries"), F.sum(F.when(F.col("k") < 0, F.col("x"))).alias("places")
    )
    # Counts as one word.
    mean = F.transform("entries", lambda e: F.struct(e["k"].alias("k"), F.round(e["x"] / (F.col("places") / UNIT)).cast("long").alias("x")))
    return sums.select("key", mean.alias("entries"))


def _looked_up(first: DataFrame, model: Model) -> DataFrame:
    """(`place`, `entries`): the sums over the words of each text that are not cached."""
    pairs = first.select("place", F.inline("rare"))
    wanted = pairs.groupBy("word").agg(F.count("*").alias("texts"))
    wanted = stored(wanted.join(model.words.select("word", "entries"), "word", "left"), "langid-wanted", compression="zstd")
    counted = F.array(F.struct(F.lit(-1).alias("k"), F.lit(UNIT).alias("x")))
    key = _key(F.col("word")).alias("key")
    seen = wanted.filter("entries IS NOT NULL").select(key, F.concat(counted, "entries").alias("entries"))
    unseen = wanted.filter("entries IS NULL")
    vectors = seen.unionByName(_backed_off(unseen, model.grams))
    # Two lists of numbers move in less room than one of pairs.
    vectors = stored(vectors.select("key", F.col("entries.k").alias("ks"), F.col("entries.x").alias("xs")), "langid-found", compression="zstd")
    # A word that is common in the texts, though not where it was learned, does not go to one task.
    common = wanted.orderBy(F.col("texts").desc(), "word").limit(COMMON).select(key)
    common = F.broadcast(stored(common, "langid-common"))
    removed(wanted)
    pairs = pairs.select("place", key, "n")
    near = pairs.join(F.broadcast(vectors.join(common, "key")), "key")
    far = pairs.join(common, "key", "left_anti").join(vectors, "key")
    moved = near.unionByName(far).select("place", "n", "ks", "xs").repartition("place")
    # A row for each language only after the move.
    each = moved.select("place", "n", F.inline(F.arrays_zip("ks", "xs")))
    sums = each.groupBy("place", F.col("ks").alias("k")).agg(F.sum(F.col("n") * F.col("xs")).alias("x"))
    return sums.groupBy("place").agg(F.collect_list(F.struct("k", "x")).alias("entries"))


def predict(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """All columns of `docs` but the text in `row`, with `lang_pred` and `score`."""
    kept = [c for c in docs.columns if c != text]
    kind = docs.select(*kept).schema.simpleString()
    langs, base = model.langs, model.base
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("place"))
    if not langs:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast((model.cached, model.table))

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Units and number of the cached words, none for a text without a letter, and the other words."""
        known, table = sent.value
        rare_kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
        for batch in slices(batches):
            sums, times, rare = [], [], []
            for t in batch.column("text").to_pylist():
                counted = Counter(words(t))
                if not any(c.isalpha() for w in counted for c in w):
                    sums.append(None)
                    times.append(0)
                    rare.append([])
                    continue
                at, weights, others = [], [], []
                for word, n in counted.items():
                    row = known.get(word)
                    if row is None:
                        others.append((word, n))
                    else:
                        at.append(row)
                        weights.append(n)
                sums.append((np.array(weights, float) @ table[np.array(at, np.int64)]).astype(np.int64).tolist())
                times.append(sum(weights))
                rare.append([{"word": w, "n": n} for w, n in others])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("place"), pa.array(sums, pa.list_(pa.int64())), pa.array(times, pa.int64()), pa.array(rare, rare_kind)],
                names=["row", "place", "sums", "times", "rare"],
            )

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            columns = (batch.column(c).to_pylist() for c in ("sums", "times", "entries"))
            for sums, times, entries in zip(*columns, strict=True):
                if sums is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                above, kinds = np.array(sums, float), np.zeros(LONGEST + 1)
                kinds[0] = times * UNIT
                for e in entries or []:
                    if e["k"] < 0:
                        kinds[-1 - e["k"]] += e["x"]
                    else:
                        above[e["k"]] += e["x"]
                total = (above + kinds @ base) / UNIT
                share = np.exp(total - total.max())
                best = int(total.argmax())
                names.append(langs[best])
                scores.append(float(share[best] / share.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    first = f"row {kind}, place long, sums array<long>, times long, rare array<struct<word:string,n:bigint>>"
    first = stored(rows.mapInArrow(begun, first), "langid-texts", compression="zstd")
    scored = first.drop("rare").join(_looked_up(first, model), "place", "left")
    return scored.select("row", "sums", "times", "entries").mapInArrow(ended, f"row {kind}, lang_pred string, score double")
