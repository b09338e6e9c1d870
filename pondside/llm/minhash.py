"""Document fingerprints by one-permutation MinHash, on DataFrame functions alone.

Every shingle of WORDS words is hashed once. The top bits of a hash name one of BINS bins, and each bin keeps its smallest hash. An
empty bin takes the hash of another one (optimal densification): it draws bins by hashes of its own number until one is not
empty; after DRAWS draws without success it takes the bin that is not empty whose hash together with its own number is smallest,
which is a draw too, and always ends. So all texts draw alike, and bins draw apart from each other. Each bin hashes what it holds
once more with its own number, so that bins that took the same hash agree by chance apart from each other, and keeps the BITS low bits, packed into
longs. Bins of different hashes agree by chance once in 2^BITS; `likeness` takes that out of the share of bins that
agree, which makes it an estimate of the Jaccard likeness of the sets of shingles.

Defined results: a NULL text is empty; a text of fewer words than WORDS has one shingle, of all it has; a text without a word has
an empty fingerprint, whose likeness is 1 to another empty one and 0 to the rest. Whole texts count, and equal texts have equal
fingerprints. The cost of a text grows with its length and the sort of its hashes. Repeated rows each get their own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import let, stored

WORDS = 5
BINS, BITS = 256, 4
DRAWS = 8
BLANKS = " \t\n\x0b\x0c\r"
_LANES = 64 // BITS
# Lowest bit of every lane of a long.
_ONES = sum(1 << BITS * lane for lane in range(_LANES))
_TOP = 64 - (BINS.bit_length() - 1)


def _hashes(text: Column) -> Column:
    """The hash of every shingle, ascending; NULL for a text without a word."""
    blanks = F.lit(BLANKS)

    def shingles(words: Column) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(words) - WORDS + 1), lambda i: F.xxhash64(F.slice(words, i, WORDS)))
        return F.when(F.size(words) < WORDS, F.array(F.xxhash64(words))).otherwise(every)

    words = F.split(F.trim(text, blanks), r"[\x20\x09-\x0D]+")
    return F.when(F.trim(text, blanks) != "", F.sort_array(let(words, shingles)))


def _bin(value: Column) -> Column:
    """The number of a hash's bin; bins and hashes ascend alike."""
    return F.shiftright(value, _TOP).cast("int") + BINS // 2


def _dense(least: Column) -> Column:
    """One hash for each bin, of the smallest hash of each that is not empty."""

    def filled(bins: Column) -> Column:
        own = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.get(least, F.array_position(bins, b).cast("int") - 1))
        return let(own, drawn)

    def drawn(own: Column) -> Column:
        def donor(value: Column, b: Column) -> Column:
            draws = [F.get(own, F.pmod(F.xxhash64(b, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(DRAWS)]
            last = F.array_min(F.transform(least, lambda x: F.struct(F.xxhash64(b, _bin(x)).alias("draw"), x.alias("value"))))
            return F.coalesce(value, *draws, last["value"])

        return F.transform(own, donor)

    return F.when(F.size(least) == BINS, least).otherwise(let(F.transform(least, _bin), filled))


def _packed(dense: Column) -> Column:
    def packed(mixed: Column) -> Column:
        def lanes(begin: Column) -> Column:
            low = F.transform(F.slice(mixed, begin, _LANES), lambda x: x.bitwiseAND(F.lit((1 << BITS) - 1)))
            return F.aggregate(low, F.lit(0).cast("long"), lambda n, x: F.shiftleft(n, BITS).bitwiseOR(x))

        return F.transform(F.sequence(F.lit(1), F.lit(BINS), F.lit(_LANES)), lanes)

    return let(F.transform(dense, lambda x, b: F.xxhash64(x, b)), packed)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint, an array of longs; empty for a text without a word."""

    def smallest(hashes: Column) -> Column:
        first = F.filter(hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(hashes, i - 1))))
        return let(first, lambda least: let(_dense(least), _packed))

    none = F.array().cast("array<bigint>")
    return F.coalesce(let(_hashes(F.coalesce(text, F.lit(""))), lambda h: F.when(h.isNotNull(), smallest(h))), none)


def shown(packed: Column) -> Column:
    """A fingerprint as lowercase hex digits."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """Estimate of the Jaccard likeness, 0 to 1, from two fingerprints."""

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for step in range(BITS.bit_length() - 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, 1 << step))
        return F.bit_count(bits.bitwiseAND(F.lit(_ones()).cast("long")))

    apart = F.aggregate(F.zip_with(one, other, differing), F.lit(0), lambda n, x: n + x)
    chance = 2.0**-BITS
    agreeing = 1.0 - apart / F.lit(float(BINS))
    estimate = F.greatest(F.lit(0.0), (agreeing - chance) / (1.0 - chance))
    both = F.when(F.size(one) == F.size(other), F.when(F.size(one) == 0, F.lit(1.0)).otherwise(estimate))
    return F.coalesce(both, F.lit(0.0))


def _ones() -> int:
    return _ONES - (1 << 64) if _ONES >> 63 else _ONES


def _followers(rows: DataFrame) -> DataFrame:
    """(`place`, `id`, `chars`, `next`) in ascending order of `id`, then of the texts' hashes; after the last comes the first. `rows` is narrow.

    Ranges of the order are windows of their own; one row for each range links its last row to the first of the next one."""
    order = ["id", "hash", "place"]
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "minhash-order")
    firsts = ranged.groupBy("range").agg(F.min(F.struct(*order)).alias("first"))
    ranges = Window.partitionBy(F.lit(0)).orderBy("range")
    after = F.coalesce(F.lead("first.place").over(ranges), F.first("first.place").over(ranges))
    firsts = firsts.select("range", after.alias("after"))
    inside = F.lead("place").over(Window.partitionBy("range").orderBy(*order))
    linked = ranged.withColumn("inside", inside).join(firsts, "range")
    return linked.select("place", "id", "chars", F.coalesce("inside", "after").alias("next"))


def compared(docs: DataFrame, identity: str, text: str, part: int = 4) -> DataFrame:
    """(`id`, `chars`, `edited_sha256`, `print`, `edited_print`, `near_edited`, `near_next`) of every document.

    The edited text has its last floor(chars / `part`) characters replaced by the first as many of the next document, in
    ascending order of id (NULL first; of equal ids by a hash of the text). `docs` must be a table that is read alike twice, as
    files are. Texts are shuffled once, and of each the part that its predecessor takes."""
    place, text = F.monotonically_increasing_id().alias("place"), F.coalesce(text, F.lit(""))
    narrow = docs.select(place, F.col(identity).alias("id"), F.xxhash64(text).alias("hash"), F.char_length(text).alias("chars"))
    links = stored(_followers(narrow), "minhash-links")
    # Both joins read the same two columns, so that one shuffle serves both.
    texts = docs.select(place, text.alias("text")).hint("merge")
    taken = F.floor(F.col("chars") / part).cast("int").alias("taken")
    wanted = links.select(F.col("next").alias("place"), F.struct("place", "id", taken).alias("taker"))
    heads = texts.join(wanted, "place").select("taker.*", F.substring("text", F.lit(1), F.col("taker.taken")).alias("head"))
    whole = texts.join(heads.hint("merge"), "place")
    size = F.char_length("text")
    kept = F.substring("text", F.lit(1), size - F.col("taken"))
    whole = whole.select("place", "id", size.alias("chars"), "text", F.concat(kept, "head").alias("edited"))
    prints = whole.select(
        "place",
        "id",
        F.col("chars").cast("long").alias("chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("print"),
        fingerprint(F.col("edited")).alias("edited_print"),
    )
    prints = stored(prints, "minhash-prints")
    following = prints.select(F.col("place").alias("next"), F.col("print").alias("next_print"))
    paired = prints.join(links.select("place", "next").hint("merge"), "place").join(following.hint("merge"), "next")
    return paired.select(
        "id", "chars", "edited_sha256", "print", "edited_print",
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
