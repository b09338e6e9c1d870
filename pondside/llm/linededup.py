"""Line dedup by a deletion-neighbourhood join, on DataFrame functions alone.

A line goes if an earlier one, in the order of document id and line number, is within one edit of it: one
character inserted, removed or replaced, blanks at both ends aside. Every line of LEAST_CHARS characters or more takes part, that is
every one that is not blank; blank lines stay.

Neighbourhoods come in steps, so that a line of any length has few keys. First every quarter of the line is deleted: the hash of what is left is a key, and so is what is left with one character
more gone. Two lines within one edit share such a key whose deleted run holds the edit. Lines that share a key with
another do the same inside that quarter, with runs of its length's square root, and those that still share one delete single
characters from that run. Lines with equal remains (of the same place, or one a remain of the other) are within
one edit; each remain passes on its earliest line only, so no pairs of a group are listed. The edit distance to
that line is verified on the texts.

Defined results: texts of any length and number of lines are taken whole, in time that grows with them; NULL texts are empty, with one empty line; rows without id come before all others; equal rows are
told apart by their place in the table, the first of them is the earliest; an empty table gives no rows. Other
columns are carried along untouched. `docs` must be a table that is read alike twice, as files are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pondside.llm.common import let, stored

PARTS, SHORTEST = 4, 6
LEAST_CHARS = 1
EDITS = 1
# Up to so many rows of two or three numbers (some 24 MB) are sent to every executor.
SENT_ROWS = 1_000_000


def _sent(rows: DataFrame) -> DataFrame:
    """Broadcast where the rows are counted to be few; else the join shuffles."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def _numbered(docs: DataFrame, identity: str, text: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("place"),
        F.col(identity).alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.struct(*docs.columns).alias("row"),
    )


def _lines(numbered: DataFrame) -> DataFrame:
    """(`id`, `place`, `number`, `line`) of the lines that take part."""
    split = numbered.select("id", "place", F.posexplode(F.split("text", "\n")).alias("number", "raw"))
    blanks = F.lit(" \t\n\x0b\x0c\r")
    return split.select("id", "place", "number", F.trim("raw", blanks).alias("line")).filter(F.length("line") >= LEAST_CHARS)


def _left(within: list[Column], text: Column, size: Column, run: Column, shift: int) -> Column:
    """(`key`, `begin`, `length`) of each run deleted with `shift` characters more; the key stands for what is left."""

    def key(j):
        kept = [text.substr(F.lit(1), j * run), text.substr((j + 1) * run + 1 + shift, size)]
        return F.struct(
            F.xxhash64(*within, size - shift, j, *kept).alias("key"), (j * run + 1).alias("begin"), (run + shift).alias("length")
        )

    last = F.greatest(F.lit(0), F.ceil((size - shift) / run).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), key)


def _keyed(rows: DataFrame, text: Column, run, within: list[Column], shortest: int) -> DataFrame:
    """`rows` with `keys`: of every run, alone and with one character more. `run` gives a run's length from a size."""
    length = [F.greatest(F.lit(shortest), F.ceil(run(F.col("size") - shift))).cast("int") for shift in (0, EDITS)]
    rows = rows.withColumn("size", F.length(text)).withColumns({"run0": length[0], "run1": length[1]})
    keys = [_left(within, text, F.col("size"), F.col(f"run{shift}"), shift) for shift in (0, EDITS)]
    return rows.withColumn("keys", F.concat(*keys)).drop("size", "run0", "run1")


def _sharing(rows: DataFrame) -> DataFrame:
    """`rows` once for each key that another class shares, with `key`, and `begin` and `length` of the deleted run."""
    listed = rows.select(*(c for c in rows.columns if c != "keys"), F.inline("keys"))
    shared = listed.groupBy("key").agg(F.min("one").alias("a"), F.max("one").alias("b")).filter("a != b").select("key")
    return listed.join(_sent(stored(shared, "line-keys")), "key")


def _earlier(near: DataFrame) -> DataFrame:
    """(`one`, `other`, `to`) for classes of which an earlier class is within one edit; `near` has the deleted `run_text`."""
    size = F.length("run_text")
    left = F.transform(
        F.sequence(F.lit(0), size),
        lambda i: F.struct(
            i.alias("cut"),
            F.when(i == 0, F.xxhash64("run_text"))
            .otherwise(F.xxhash64(F.concat(F.substring("run_text", 1, i - 1), F.col("run_text").substr(i + 1, size))))
            .alias("remain"),
        ),
    )
    rows = near.select("key", F.struct("first", "one", "other").alias("me"), size.alias("size"), F.inline(left))
    alike = Window.partitionBy("key", "remain")
    same_place = Window.partitionBy("key", "remain", "cut", "size")
    whole = F.min(F.when(F.col("cut") == 0, F.col("me"))).over(alike)
    cut = F.min(F.when(F.col("cut") > 0, F.col("me"))).over(alike)
    to = F.when(F.col("cut") == 0, cut).otherwise(F.least(F.min("me").over(same_place), whole))
    found = rows.withColumn("to", to).filter(F.col("to") < F.col("me"))
    return found.groupBy("me.one", "me.other").agg(F.min("to").alias("to"))


def removed_lines(numbered: DataFrame) -> DataFrame:
    """(`place`, `number`) of every line that goes."""
    lines = _lines(numbered)
    identity = [F.xxhash64("line").alias("one"), F.xxhash64(F.lit(EDITS), "line").alias("other")]
    shaped = _keyed(lines.select("*", *identity), F.col("line"), lambda size: size / PARTS, [], 1).drop("line")
    shaped = stored(shaped, "line-shapes")
    at = F.struct("id", "place", "number")
    classes = shaped.groupBy("one", "other").agg(F.min(at).alias("first"), F.count("*").alias("lines"))
    classes = stored(classes, "line-classes")
    near = stored(_sharing(shaped), "line-neighbours")
    wanted = near.select("place", "number").distinct()
    texts = lines.select("place", "number", "line").join(_sent(wanted), ["place", "number"])
    texts = stored(texts.select(*identity, "line").dropDuplicates(["one", "other"]), "line-texts")
    # One row for each class and key; the run that the key deletes takes the line's place.
    run_text = F.col("line").substr(F.col("begin"), F.col("length"))
    once = near.select("key", "one", "other", "begin", "length").distinct().join(texts, ["one", "other"])
    inner = once.select("one", "other", F.col("key").alias("outer"), run_text.alias("text"))
    inner = stored(_keyed(inner, F.col("text"), F.sqrt, [F.col("outer")], SHORTEST), "line-runs")
    inner = _sharing(inner).select("key", "one", "other", F.col("text").substr(F.col("begin"), F.col("length")).alias("run_text"))
    inner = stored(inner.distinct().join(classes, ["one", "other"]), "line-inner")
    found = stored(_earlier(inner), "line-earlier")
    mine = found.join(texts, ["one", "other"]).withColumnRenamed("line", "mine")
    theirs = texts.select(F.col("one").alias("to_one"), F.col("other").alias("to_other"), F.col("line").alias("theirs"))
    pairs = mine.withColumns({"to_one": F.col("to.one"), "to_other": F.col("to.other")}).join(theirs, ["to_one", "to_other"])
    gone = pairs.filter(F.levenshtein("mine", "theirs", EDITS) >= 0).select("one", "other", F.lit(True).alias("gone"))
    acting = classes.join(gone, ["one", "other"], "left").filter("lines > 1 or gone")
    acting = acting.select("one", "other", "first", F.coalesce("gone", F.lit(False)).alias("gone"))
    every = shaped.select("one", "other", "place", "number", at.alias("at")).join(acting, ["one", "other"])
    return every.filter(F.col("gone") | (F.col("at") != F.col("first"))).select("place", "number")


def deduped(docs: DataFrame, identity: str, text: str) -> DataFrame:
    """All columns of `docs` in `row`, with `lines` (how many there were), `removed` (numbers of those that go) and `kept`, the
    text of the others."""
    numbered = _numbered(docs, identity, text)
    gone = removed_lines(numbered).groupBy("place").agg(F.array_sort(F.collect_list("number")).alias("gone"))
    gone = stored(gone, "line-removed")
    few = gone.agg(F.coalesce(F.sum(F.size("gone") + 2), F.lit(0))).first()[0] <= SENT_ROWS
    split = F.split("text", "\n")
    marked = numbered.join(F.broadcast(gone) if few else gone, "place", "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    # The text is split once, whatever the number of lines.
    kept = F.array_join(let(split, lambda lines: F.transform(left, lambda i: F.element_at(lines, i + 1))), "\n")
    return marked.select(
        "row",
        F.size(split).alias("lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )
