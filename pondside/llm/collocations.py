"""Phrase collocation mining over Rabin-Karp fingerprints.

A text is cut at marks and line ends into pieces, and those into words. Phrases are runs of up to LONGEST words of a piece, counted for each
language. Prefix polynomials, over the bytes of words and then over the words, give the fingerprint of every run as the difference of two
prefixes, on numpy arrays of many texts at once. There are two polynomials to two bases: `fp` and `check`.

Tasks sum runs of equal `fp` before they are shuffled. Where the words of one differ from those of the first of its fingerprint, they are
told apart by the words themselves; runs of different tasks are one phrase if both fingerprints, 128 bits, agree. Each carries a pointer to
a document that holds it. Only frequent phrases are made text: their documents are found by the pointers, and each phrase is read where both of
its fingerprints stand. Longer runs take a second reading: pairs of words that are frequent set a bit in a filter, and only runs of which
all pairs pass it are counted. Filters have a fixed size, whatever the number of phrases or documents; they pass the driver and are sent to
every executor, and a bit too many only costs work.

The lowest score of a phrase's cuts counts, where a cut after k words scores floor(1000 * a * n / (l * r)): a occurrences of the phrase, l and
r of its parts, n words in the language. A phrase goes if its words lie inside a longer one that occurs as often; as every occurrence of
the longer one holds one of the phrase, counts in between are equal too, so the phrases one word longer tell. Parts that begin or end very
many phrases are joined in pieces.

Defined results: a NULL text is empty, a NULL language `und`; repeated rows count each time; ties go to the larger count, then to
the phrase that is smaller byte by byte; an empty table gives no rows. Texts of any length are read whole. Only the two columns named are read.
`docs` must be a table that is read alike twice, as files are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import small_batches, stored
from pondside.operators.joins import hot_keys, spread_join

LONGEST = 5
FILTER = 1 << 26
# Bytes of text looked at together, and runs a task holds before it sums them and passes them on, ROWS in a batch.
SLICE, HELD, ROWS = 250_000, 250_000, 50_000
# What ends a piece, and words; the blanks between them are space and tab.
MARKS, WORDS = "[.,;:!?\n-\r]+", r"[^\x20\x09.,;:!?\x0A-\x0D]+"
UNKNOWN = "und"
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; different ones stay different."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _polynomials(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomials of numbers, in falling powers of the base, and its rising powers, which make up for them."""
    back = pow(base, -1, 1 << 64)
    falling, rising = np.full(len(values) + 1, back, np.uint64), np.full(len(values) + 1, base, np.uint64)
    falling[0] = rising[0] = 1
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * np.cumprod(falling)[: len(values)], out=sums[1:])
    return sums, np.cumprod(rising)


def _hashes(words: pa.Array, base: int) -> np.ndarray:
    """Of each word the polynomial of its bytes."""
    words = words.cast(pa.large_string())
    _, places, data = words.buffers()
    ends = np.frombuffer(places, np.int64)[words.offset : words.offset + len(words) + 1]
    sums, powers = _polynomials(np.frombuffer(data or b"", np.uint8)[: ends[-1]].astype(np.uint64) + np.uint64(1), base)
    return _mixed((sums[ends[1:]] - sums[ends[:-1]]) * powers[ends[:-1]])


@dataclass
class Words:
    """The words of some texts in a row: `ids` into `known`, number of the `piece`, which ascends, the `text` each is of, and `langs`
    by text."""

    known: pa.Array
    ids: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    lang_names: pa.Array
    langs: np.ndarray

    @classmethod
    def of(cls, part: pa.RecordBatch) -> Words:
        texts = pc.ascii_lower(part.column("text")).cast(pa.large_string())
        texts = pc.replace_substring_regex(texts, pattern=MARKS, replacement=" \n ")
        split = pc.split_pattern(pc.replace_substring(texts, pattern="\t", replacement=" "), pattern=" ")
        coded = split.flatten().dictionary_encode()
        ids = coded.indices.to_numpy(zero_copy_only=False)
        # Position of the two tokens that are no words, or one that no token has.
        empty, mark = (pc.index(coded.dictionary, pa.scalar(x, pa.large_string())).as_py() for x in ("", "\n"))
        text = np.repeat(np.arange(part.num_rows), np.diff(split.offsets.to_numpy()))
        ends = ids == mark
        ends[1:] |= text[1:] != text[:-1]
        word = (ids != empty) & (ids != mark)
        langs = part.column("lang").dictionary_encode()
        by_text = langs.indices.to_numpy(zero_copy_only=False)
        return cls(coded.dictionary, ids[word], np.cumsum(ends)[word], text[word], langs.dictionary, by_text)

    def prints(self, base: int) -> Callable:
        """Gives the fingerprints of the runs of a size that begin at some places."""
        sums, powers = _polynomials(_hashes(self.known, base)[self.ids], base)
        lang = _hashes(self.lang_names, base)[self.langs][self.text]

        def found(at: np.ndarray, size: int) -> np.ndarray:
            return _mixed((sums[at + size] - sums[at]) * powers[at] + lang[at] * np.uint64(2 * size + 1))

        return found

    def runs(self, sizes: range, passes: Callable | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each size the places where a run of so many words begins, all of whose pairs pass, and both fingerprints."""
        if not len(self.ids):
            return
        prints, checks = (self.prints(base) for base in BASES)
        inside = self.piece[1:] == self.piece[:-1]
        if passes:
            pairs = np.flatnonzero(inside)
            inside[pairs] = passes(prints(pairs, 2))
        at = np.arange(len(self.ids))
        for size in range(1, max(sizes) + 1):
            if size > 1:
                at = at[at + size - 1 < len(self.ids)]
                at = at[inside[at + size - 2]]
            if size in sizes:
                yield size, at, prints(at, size), checks(at, size)

    def written(self, at: np.ndarray, size: int) -> pa.Array:
        """The runs as text."""
        parts = [self.known.take(pa.array(self.ids[at + k])) for k in range(size)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Some texts at a time and their words; a longer text is looked at alone."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + SLICE, side="right")))
            part = batch.slice(at, end - at)
            yield part, Words.of(part)
            at = end


def _bit(prints: np.ndarray) -> np.ndarray:
    return prints >> np.uint64(64 - (FILTER.bit_length() - 1))


def _passes(sent) -> Callable:
    """Whether a filter holds the bit of each fingerprint."""
    bits = np.frombuffer(sent.value, np.uint8)

    def passes(prints: np.ndarray) -> np.ndarray:
        bit = _bit(prints)
        return (bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

    return passes


def _filter(rows: DataFrame, print_: str) -> bytes:
    """The bits of the fingerprints in a column: up to FILTER / 64 rows of a place and 64 bits pass the driver."""
    bit = F.shiftrightunsigned(print_, 64 - (FILTER.bit_length() - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    rows = rows.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    bits = np.zeros(max(1, FILTER // 64), "<i8")
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits.tobytes()


def _verified(words: Words, size: int, at: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the runs is the first of each distinct one, and how often that is met. Runs are told apart by fingerprint; where the
    words of one differ from those of the first of its fingerprint, by all their words."""
    _, first, group, times = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    like = at[first][group]
    same = words.langs[words.text[at]] == words.langs[words.text[like]]
    for k in range(size):
        same &= words.ids[at + k] == words.ids[like + k]
    if same.all():
        return first, times
    rows = np.stack([words.langs[words.text[at]], *(words.ids[at + k] for k in range(size))], axis=1)
    _, first, times = np.unique(rows, axis=0, return_index=True, return_counts=True)
    return first, times


def _summed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Runs summed by both fingerprints, with the smallest pointer."""
    prints, checks, times, places = map(np.concatenate, zip(*held, strict=True))
    order = np.argsort(prints, kind="stable")
    prints, checks, times, places = prints[order], checks[order], times[order], places[order]
    new = np.flatnonzero(np.append(True, (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1]))[: len(prints)])
    columns = [prints[new].view(np.int64), checks[new].view(np.int64)]
    columns += [np.add.reduceat(times, new), np.minimum.reduceat(places, new)] if len(new) else [times, places]
    rows = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["fp", "check", "n", "place"])
    yield from (rows.slice(at, ROWS) for at in range(0, rows.num_rows, ROWS))


def _counted(sizes: range, sent=None) -> Callable:
    """(`fp`, `check`, `n`, `place`) of the runs of some sizes, summed as far as they are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = sent and _passes(sent)
        held: list[tuple] = []
        for part, words in _slices(batches):
            places = part.column("place").to_numpy()
            for size, at, prints, checks in words.runs(sizes, passes):
                first, times = _verified(words, size, at, prints)
                held.append((prints[first], checks[first], times, places[words.text[at[first]]]))
            if sum(len(x[0]) for x in held) >= HELD:
                yield from _summed(held)
                held = []
        if held:
            yield from _summed(held)

    return run


def _pointed_at(sent) -> Callable:
    """The texts whose place passes a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = _passes(sent)
        for batch in batches:
            places = batch.column("place").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(passes(_mixed(places))))

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(`lang`, `words`, `phrase`, `n`) of the `wanted` runs (`fp`, `check`, `n`) of each text."""
    for part, words in _slices(batches):
        found = [(*run[1:], np.full(len(run[1]), run[0])) for run in words.runs(range(1, LONGEST + 1))]
        if not found:
            continue
        at, prints, checks, sizes = map(np.concatenate, zip(*found, strict=True))
        texts = words.text[at]
        lists = part.column("wanted")
        wanted = lists.flatten()
        fp, check = (wanted.field(n).to_numpy().view(np.uint64) for n in ("fp", "check"))
        of = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
        # Runs in the order of one number made of the three; equal numbers stand together.
        mine, order = _mixed(fp + _mixed(check + of.astype(np.uint64))), _mixed(prints + _mixed(checks + texts.astype(np.uint64)))
        rank = np.argsort(order, kind="stable")
        first = rank[np.searchsorted(order[rank], mine)]
        if not ((prints[first] == fp) & (checks[first] == check) & (texts[first] == of)).all():
            raise ValueError("a text does not hold the run that points to it")
        times = wanted.field("n").to_numpy()
        for size in np.unique(sizes[first]):
            here = sizes[first] == size
            begin = at[first][here]
            names = words.lang_names.take(pa.array(words.langs[words.text[begin]])).cast(pa.string())
            columns = [names, pa.array(np.full(len(begin), size, np.int32)), words.written(begin, size).cast(pa.string()), pa.array(times[here])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])


def _kept(rows: DataFrame, name: str, by: str) -> DataFrame:
    """Rows that are few beside those they come from, stored in as many files as they fill, not in one for each task that finds some.
    They are dealt by a column, so a task that is run again deals them alike. Without its native library Hadoop starts a process for
    each file it makes, and until that is its own program, the memory of the JVM shows twice."""
    return stored(rows.hint("rebalance", by), name)


def phrases(docs: DataFrame, text: str, lang: str, least: int) -> DataFrame:
    """(`lang`, `words`, `phrase`, `n`): all runs of up to LONGEST words that occur `least` times in a language."""
    small_batches(docs.sparkSession)
    place = F.monotonically_increasing_id().alias("place")
    texts = docs.select(place, F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext

    def frequent(count: Callable, name: str) -> DataFrame:
        counted = texts.mapInArrow(count, "fp long, check long, n long, place long").groupBy("fp", "check")
        return _kept(counted.agg(F.sum("n").alias("n"), F.min("place").alias("place")).filter(F.col("n") >= least), name, "fp")

    short = frequent(_counted(range(1, 3)), "phrase-pairs")
    pairs = context.broadcast(_filter(short, "fp"))
    every = short.unionByName(frequent(_counted(range(3, LONGEST + 1), pairs), "phrase-runs"))
    # A document's list is at most as long as all its runs.
    wanted = every.groupBy("place").agg(F.collect_list(F.struct("fp", "check", "n")).alias("wanted"))
    wanted = _kept(wanted, "phrase-places", "place")
    places = wanted.select("place").mapInArrow(_mixed_places, "fp long")
    owners = texts.mapInArrow(_pointed_at(context.broadcast(_filter(places, "fp"))), texts.schema)
    held = owners.hint("merge").join(wanted.hint("merge"), "place")
    return _kept(held.mapInArrow(_read, "lang string, words int, phrase string, n long"), "phrase-counts", "phrase")


def _mixed_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"fp": _mixed(batch.column("place").to_numpy().view(np.uint64)).view(np.int64)})


def _key(phrase: Column) -> Column:
    """Language and phrase in one; no phrase holds a tab."""
    return F.concat("lang", F.lit("\t"), phrase)


def _cuts(candidates: DataFrame) -> DataFrame:
    """A row for each place a phrase can be cut at: `k` words of it are in `left`, the others in `right`."""
    words = F.split("phrase", " ", -1)
    rows = candidates.withColumn("parts", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    left = F.array_join(F.slice("parts", 1, F.col("k")), " ")
    right = F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ")
    return rows.select("key", "lang", "words", "a", "k", _key(left).alias("left"), _key(right).alias("right"))


def collocations(docs: DataFrame, text: str, lang: str, least: int = 100, most: int = 2000) -> DataFrame:
    """(`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`): the `most` best phrases of each language that occur `least` times."""
    every = F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")
    totals = docs.groupBy(F.coalesce(lang, F.lit(UNKNOWN)).alias("lang")).agg(F.sum(every).alias("total"))
    known = phrases(docs, text, lang, least)
    known = known.select(_key(F.col("phrase")).alias("key"), "lang", "words", "phrase", F.col("n").alias("a"))
    candidates = known.filter("words > 1")
    cuts = _kept(_cuts(candidates), "phrase-cuts", "key")
    counted = cuts
    for side, count in (("left", "l"), ("right", "r")):
        parts = known.filter(F.col("words") < LONGEST).select(F.col("key").alias(side), F.col("a").alias(count))
        counted = spread_join(counted, parts, side, ["key", "k"], hot_keys(cuts, side))
    # One row for each language.
    counted = counted.join(F.broadcast(totals), "lang")
    score = F.expr(
        "(1000BD * CAST(a AS DECIMAL(16, 0)) * CAST(total AS DECIMAL(16, 0)))"
        " DIV (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"
    )
    cut = F.struct(score.cast("long").alias("score"), "k", "l", "r", "total")
    scored = counted.groupBy("key").agg(F.min(cut).alias("cut"))
    ends = F.explode(F.array(F.when(F.col("k") == 1, F.col("right")), F.when(F.col("k") == F.col("words") - 1, F.col("left"))))
    inner = cuts.filter("words > 2").select(ends.alias("key"), "a").filter("key IS NOT NULL")
    covers = inner.groupBy("key").agg(F.max("a").alias("cover"))
    kept = candidates.join(scored, "key").join(covers, "key", "left").filter("cover IS NULL OR 100 * cover < 100 * a")
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("cut.total").alias("n"), "cut.score"
    )
