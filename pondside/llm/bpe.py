"""BPE encoding and decoding with tree concatenation.

A text is cut where the tokenizer's own splitting always cuts: between a word and the blanks after it. Long texts
go to the executors in such pieces. A stretch without any such place that is too long for a piece (a single word,
a run of blanks) is halved until its parts are short; the parts are encoded in parallel and joined as a tree: at
each join a window of tokens from both sides is encoded anew and grows until its outer tokens agree with what was
there. A sequence of which every two neighbours are the encoding of their bytes is the encoding of the whole,
so what agreement leaves is exact.

Defined results: a NULL or empty text has no tokens and decodes to the empty text; equal rows each get their own
result; an empty table gives no rows. Only the columns asked for are read, so others may have any name.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from pondside.llm.common import small_batches

PIECE = 32_768
WINDOW = 8
CACHE = 200_000
# Bytes of text whose tokens are held at a time.
SLICE = 1_000_000
# Fixed values of the byte-level scheme: its splitting pattern, and the bytes that stand for themselves.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that every version of Unicode's tables puts into the same class, as far as the pattern tells them apart.
SETTLED = r"[\x00-\u052F\u2000-\u2064\u20A0-\u20BF\u3041-\u3096\u30A0-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3\U0001F300-\U0001F5FF\U0001F601-\U0001F64F]*+"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary."""
    others = iter(range(256, 512))
    return [chr(b) if b in set(PRINTABLE) else chr(next(others)) for b in range(256)]


class Codec:
    """Encodes pieces with the library's merges and remembers words met before."""

    def __init__(self, spec: str):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        back = {letter: bytes([b]) for b, letter in enumerate(letters)}
        self.bytes_of = {}
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes_of[number] = b"".join(back[c] for c in token)
        self.special = {t.content: n for n, t in self.tokenizer.get_added_tokens_decoder().items()}
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pattern, self.settled = regex.compile(SPLIT), regex.compile(SETTLED)
        self.known: dict[str, tuple[int, ...]] = {}
        # One object for each number, shared by all words that are remembered.
        self.numbers = {number: number for number in self.bytes_of}

    def split(self, text: str) -> list[str]:
        """The words of a text; where tables may differ, as the library itself cuts them."""
        if self.settled.fullmatch(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, data: bytes) -> list[int]:
        """The tokens of bytes that are not split."""
        return [t.id for t in self.model.tokenize(data.decode("latin-1").translate(self.letters))]

    def encode(self, text: str) -> list[int]:
        parts = [text]
        if self.special_cut and any(s in text for s in self.special):
            parts = self.special_cut.split(text)
        known, ids = self.known, []
        for part in parts:
            if part in self.special:
                ids.append(self.special[part])
                continue
            for word in self.split(part):
                found = known.get(word)
                if found is None:
                    found = self.halved(word) if len(word) > PIECE else self.merge(word.encode())
                    if len(word) < 64:
                        if len(known) >= CACHE:
                            known.clear()
                        known[word] = tuple(map(self.numbers.__getitem__, found))
                ids += found
        return ids

    def halved(self, word: str) -> list[int]:
        return self.concatenated([self.merge(x.encode()) for x in halves(word)])

    def concatenated(self, parts: list[list[int]]) -> list[int]:
        """Joins neighbours in pairs, then pairs of pairs, until one sequence is left."""
        while len(parts) > 1:
            pairs = [self.join(*parts[i : i + 2]) for i in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        return parts[0] if parts else []

    def join(self, left: list[int], right: list[int]) -> list[int]:
        size = WINDOW
        while True:
            a, b = left[-size:], right[:size]
            new = self.merge(b"".join(map(self.bytes_of.__getitem__, a + b)))
            if (len(a) == len(left) or new[:2] == a[:2]) and (len(b) == len(right) or new[-2:] == b[-2:]):
                return left[: len(left) - len(a)] + new + right[len(b) :]
            size *= 2

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(spec: str) -> Codec:
    """One per worker process and tokenizer."""
    return Codec(spec)


def halves(word: str, size: int = PIECE) -> list[str]:
    """The word, halved until no part is longer than `size`."""
    if len(word) <= size:
        return [word]
    middle = len(word) // 2
    return halves(word[:middle], size) + halves(word[middle:], size)


def pieces(codec: Codec, text: str, size: int = PIECE) -> Iterator[tuple[str, bool]]:
    """Parts of the text in order, and whether a part goes on in the next one, inside a word."""
    safe = regex.compile(r"(?<=\S)(?=\s)")
    at = 0
    while len(text) - at > size:
        cuts = [m.start() for m in safe.finditer(text, at + size // 2, at + size)]
        if cuts:
            yield text[at : cuts[-1]], False
            at = cuts[-1]
            continue
        end = next((m.start() for m in safe.finditer(text, at + size)), len(text))
        stretch = text[at:end]
        for part in codec.special_cut.split(stretch) if codec.special_cut else [stretch]:
            if part in codec.special:
                yield part, False
                continue
            kept: list[str] = []
            held = 0
            for word in codec.split(part):
                if kept and held + len(word) > size:
                    yield from _apart(kept)
                    kept, held = [], 0
                if len(word) <= size:
                    kept.append(word)
                    held += len(word)
                    continue
                short = halves(word, size)
                for k, half in enumerate(short):
                    yield half, k < len(short) - 1
            if kept:
                yield "".join(kept), False
        at = end
    if at < len(text):
        yield text[at:], False


def _apart(words: list[str]) -> Iterator[tuple[str, bool]]:
    """Words as one part; blanks at its end apart, for how they are split depends on what follows them."""
    end = len(words)
    while end and words[end - 1].isspace():
        end -= 1
    yield "".join(words[:end]), False
    yield from ((w, False) for w in words[end:])


def _lists(values: list[list[int]]) -> pa.ListArray:
    flat = np.fromiter((i for v in values for i in v), np.int32, sum(map(len, values)))
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, flat)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of up to SLICE bytes of text, so that the tokens of few texts are held at a time; a longer text alone."""
    sizes = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + SLICE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _whole(spec) -> Callable:
    def run(batches):
        c = codec(spec.value)
        for batch in batches:
            for part in _slices(batch, "text"):
                ids = [c.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), _lists(ids), pa.array([c.decode(i) for i in ids], pa.string())],
                    names=["key", "ids", "decoded"],
                )

    return run


def _cut(spec, size: int) -> Callable:
    def run(batches):
        c = codec(spec.value)
        for batch in batches:
            for at in range(batch.num_rows):
                key, row, text = (batch.column(n)[at].as_py() for n in ("key", "row_id", "text"))
                made = list(pieces(c, text, size))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([key] * len(made), batch.schema.field("key").type),
                        "row_id": pa.array([row] * len(made), pa.int64()),
                        "seq": pa.array(range(len(made)), pa.int64()),
                        "piece": pa.array([p for p, _ in made], pa.string()),
                        "goes_on": pa.array([g for _, g in made], pa.bool_()),
                    }
                )

    return run


def _encode_pieces(spec) -> Callable:
    def run(batches):
        c = codec(spec.value)
        for batch in batches:
            for part in _slices(batch, "piece"):
                texts, on = part.column("piece").to_pylist(), part.column("goes_on").to_pylist()
                ids = [c.merge(t.encode()) if g else c.encode(t) for t, g in zip(texts, on, strict=True)]
                kept = [part.column(n) for n in ("key", "row_id", "seq", "goes_on")]
                yield pa.RecordBatch.from_arrays([*kept, _lists(ids)], names=["key", "row_id", "seq", "goes_on", "ids"])

    return run


def _joined(spec) -> Callable:
    def run(group: pa.Table) -> pa.Table:
        c = codec(spec.value)
        group = group.sort_by("seq")
        ids: list[int] = []
        run_of: list[list[int]] = []
        for part, on in zip(group.column("ids").to_pylist(), group.column("goes_on").to_pylist(), strict=True):
            run_of.append(part)
            if not on:
                ids += c.concatenated(run_of)
                run_of = []
        return pa.table(
            {
                "key": group.column("key").slice(0, 1),
                "ids": _lists([ids]),
                "decoded": pa.array([c.decode(ids)], pa.string()),
            }
        )

    return run


def round_trip(docs: DataFrame, key: str, text: str, spec: str, piece: int = PIECE) -> DataFrame:
    """(`key`, `ids`, `decoded`) of each row; `spec` is the tokenizer's JSON. A text longer than `piece`
    characters is encoded in pieces, spread over the executors and joined again in one task, which holds the
    tokens of that text alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(json.dumps(json.loads(spec), ensure_ascii=False))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    long = F.length("text") > piece
    done = f"key {kind}, ids array<int>, decoded string"
    short = rows.filter(~long).mapInArrow(_whole(shared), done)
    cut = rows.filter(long).withColumn("row_id", F.monotonically_increasing_id())
    cut = cut.mapInArrow(_cut(shared, piece), f"key {kind}, row_id long, seq long, piece string, goes_on boolean")
    parts = cut.repartition("row_id", "seq").mapInArrow(
        _encode_pieces(shared), f"key {kind}, row_id long, seq long, goes_on boolean, ids array<int>"
    )
    return short.unionByName(parts.groupBy("row_id").applyInArrow(_joined(shared), done)).withColumnRenamed("key", key)
