"""Toxicity by weak supervision.

Voters are lexicons of words and patterns of word beginnings, drawn up from labelled rows, besides two patterns of
typography. A generative model of the votes of all documents to learn from, without their labels, estimates how
often each voter fires on either kind (its accuracy) by expectation maximisation. Voters that agree more than
their kinds explain are correlated; they are grouped, and a group's joint vote is modelled as one. The model's
posteriors then label a bounded sample, on which a linear classifier over terms is trained; it scores the table.

Voters and classifier are drawn from at most MAX_LABELLED and MAX_TRAINED rows, by hash; votes are counted over all rows to
learn from. There are VOTERS voters at most, so 2^VOTERS vote patterns at most reach the driver.

Defined results: NULL and empty texts hold no term and get the score of a text without any; labels other than 0
and 1 are ignored; with nothing to learn from every score is 0; an empty table gives no rows. Other columns are
carried along untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pondside.llm.common import stored
from pondside.llm.labelled import sample

MAX_LABELLED = 20_000
MAX_TRAINED = 20_000
LEXICONS, PATTERNS, VOTERS = 6, 4, 12
PREFIXES = (4, 5, 6)
MAX_TERMS = 600
MAX_FEATURES = 2_000
LEAST_ROWS = 6
LEAST_SHARE = 0.7
# Standard deviations by which a term's share of toxic rows must stand out to become a feature.
LEAST_PULL = 8.0
PENALTY, LASSO = 0.005, 1.0
# Of the toxic rows a voter's term marks at least this share, else it may be a word of a few copies.
LEAST_PART = 0.01
CORRELATED = 4.0
LARGEST_GROUP = 3
ROUNDS = 200
_WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    """The word itself and its beginnings; a beginning ends in a star."""
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


def text_terms(text: str | None) -> set[str]:
    words = set(_WORD.findall(text.lower())) if text else ()
    return {t for w in words for t in terms_of(w)}


@dataclass
class Finder:
    """Finds given terms in texts; most words are settled by one look at their first letters."""

    terms: list[str]
    by_start: dict[str, list[tuple[str, int, bool]]] = field(default_factory=dict)

    def __post_init__(self):
        for k, term in enumerate(self.terms):
            bare = term.rstrip("*")
            self.by_start.setdefault(bare[: PREFIXES[0]], []).append((bare, k, term.endswith("*")))

    def __call__(self, text: str | None) -> set[int]:
        found: set[int] = set()
        if not text:
            return found
        starts = self.by_start
        for word in set(_WORD.findall(text.lower())):
            for bare, k, begins in starts.get(word[:4], ()):
                if (word != bare and word.startswith(bare)) if begins else word == bare:
                    found.add(k)
        return found


@dataclass
class Voters:
    """Bits of the voters that fire on a text: lexicons, patterns, then typography."""

    finder: Finder
    voter_of: list[int]

    def __call__(self, text: str | None) -> int:
        fired = 0
        for k in self.finder(text):
            fired |= 1 << self.voter_of[k]
        text = text or ""
        if text.count("!") * 100 > len(text):
            fired |= 1 << (VOTERS - 2)
        if 3 * sum(map(str.isupper, text)) > len(text) > 0:
            fired |= 1 << (VOTERS - 1)
        return fired


def _term_counts(rows: DataFrame) -> DataFrame:
    """(`term`, `weight`, `n`): in how many rows of `text` a term stands, and the sum of their `label`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, weight = Counter(), Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(list(n), pa.string()),
                    "weight": pa.array([float(weight[t]) for t in n], pa.float64()),
                    "n": pa.array(list(n.values()), pa.int64()),
                }
            )
            n.clear()
            weight.clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                terms = text_terms(text)
                n.update(terms)
                if label > 0:
                    for t in terms:
                        weight[t] += label
            if len(n) > 300_000:
                yield flushed()
        yield flushed()

    counted = rows.mapInArrow(count, "term string, weight double, n long")
    return counted.groupBy("term").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))


def draw_voters(labelled: DataFrame) -> Voters:
    """Terms that stand mostly in toxic rows, dealt to the lexicons and patterns in turn by how many rows they mark."""
    share = F.col("weight") / (F.col("n") + 1)
    toxic = labelled.agg(F.coalesce(F.sum("label"), F.lit(0.0))).first()[0]
    least = max(LEAST_ROWS, LEAST_PART * toxic)
    marked = _term_counts(labelled).filter((F.col("n") >= least) & (share >= LEAST_SHARE))
    rows = marked.orderBy((F.col("weight") * share).desc(), "term").limit(MAX_TERMS).collect()
    terms, voter_of, dealt = [], [], [0, 0]
    for r in rows:
        begins = r["term"].endswith("*")
        size, first = (PATTERNS, LEXICONS) if begins else (LEXICONS, 0)
        terms.append(r["term"])
        voter_of.append(first + dealt[begins] % size)
        dealt[begins] += 1
    return Voters(Finder(terms), voter_of)


def _votes(docs: DataFrame, voters: Voters) -> DataFrame:
    """`docs` (`id`, `text`) with `votes`."""
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes = [sent.value(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(votes, pa.int32())], names=[*batch.schema.names, "votes"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", votes int")


def label_model(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The probability of the toxic kind for each vote pattern (rows of 0 and 1).

    Kinds start from how many voters fire; voters are grouped by correlation and the model is fitted anew."""
    groups = [[v] for v in range(patterns.shape[1])]
    start = np.where(patterns.sum(axis=1) > 0, 0.9, 0.02)
    posterior = _fitted(patterns, counts, groups, start)
    joined = _correlated(patterns, counts, posterior)
    return _fitted(patterns, counts, joined, posterior) if len(joined) < len(groups) else posterior


def _fitted(patterns: np.ndarray, counts: np.ndarray, groups: list[list[int]], posterior: np.ndarray) -> np.ndarray:
    """Expectation maximisation over the joint votes of each group."""
    joint = [patterns[:, g] @ (1 << np.arange(len(g))) for g in groups]
    for _ in range(ROUNDS):
        logs = np.zeros((len(patterns), 2))
        for kind, weight in enumerate(((1 - posterior) * counts, posterior * counts)):
            logs[:, kind] = np.log(weight.sum() + 1)
            for votes, group in zip(joint, groups, strict=True):
                seen = np.bincount(votes, weight, minlength=1 << len(group)) + 0.5
                logs[:, kind] += np.log(seen / seen.sum())[votes]
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        if np.abs(new - posterior).max() < 1e-6:
            return new
        posterior = new
    return posterior


def _correlated(patterns: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> list[list[int]]:
    """Groups of voters whose agreement within the kinds stands out by CORRELATED deviations, the closest first."""
    voters = patterns.shape[1]
    excess = np.zeros((voters, voters))
    for weight in (posterior * counts, (1 - posterior) * counts):
        total = weight.sum()
        if total < 1:
            continue
        rate = weight @ patterns / total
        both = (patterns * weight[:, None]).T @ patterns / total
        spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate)) / total) + 1e-9
        excess = np.maximum(excess, (both - np.outer(rate, rate)) / spread)
    group_of = {v: [v] for v in range(voters)}
    pairs = sorted(((excess[a, b], a, b) for a in range(voters) for b in range(a)), reverse=True)
    for value, a, b in pairs:
        one, other = group_of[a], group_of[b]
        if value > CORRELATED and one is not other and len(one) + len(other) <= LARGEST_GROUP:
            one += other
            group_of |= dict.fromkeys(other, one)
    return list({id(g): g for g in group_of.values()}.values())


@dataclass
class Model:
    finder: Finder
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        total = self.intercept + sum(self.weights[k] for k in self.finder(text))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


NOTHING = Model(Finder([]), np.zeros(0), -500.0)


def _logistic(rows: list[np.ndarray], target: np.ndarray, size: int, steps: int = 600) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal steps on the likelihood of fractional targets.

    The lasso leaves out terms whose rows others explain, such as the words of a group of copies."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.concatenate(rows).astype(np.int64) if len(at) else np.zeros(0, np.int64)
    # Columns are scaled by how often they occur, so that rare terms are learned as fast as common ones.
    scale = 1 / np.sqrt(np.bincount(columns, minlength=size) + 1)
    weights, intercept = np.zeros(size), float(np.log((target.mean() + 1e-6) / (1 - target.mean() + 1e-6)))
    ahead, ahead_b, rate = weights.copy(), intercept, 1.0 / max(1.0, max((len(r) for r in rows), default=1) / 4)
    for step in range(steps):
        total = ahead_b + np.bincount(at, (ahead * scale)[columns], minlength=len(rows))
        error = 1 / (1 + np.exp(-np.clip(total, -500, 500))) - target
        slope = np.bincount(columns, error[at], minlength=size) * scale + PENALTY * ahead * scale**2
        moved = ahead - rate * slope
        new = np.sign(moved) * np.maximum(np.abs(moved) - rate * LASSO * scale, 0)
        new_b = ahead_b - rate * error.sum() / len(rows) * 4
        push = step / (step + 3)
        ahead, ahead_b = new + push * (new - weights), new_b + push * (new_b - intercept)
        weights, intercept = new, new_b
    return weights * scale, intercept


def train(docs: DataFrame, labels: DataFrame, identity: str, text: str, label: str) -> Model:
    """A classifier from the documents given and those of their labels that are known."""
    labelled = sample(docs.select(identity, text), labels, identity, label, MAX_LABELLED)
    voters = draw_voters(labelled.select(F.col(f"row.{text}").alias("text"), "label"))
    if not voters.finder.terms:
        return NOTHING
    rows = docs.select(F.col(identity).alias("id"), F.col(text).alias("text"))
    voted = stored(_votes(rows, voters).select("id", F.xxhash64("id", "text").alias("draw"), "votes"), "toxicity-votes")
    counted = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()
    patterns = np.array([[r["votes"] >> v & 1 for v in range(VOTERS)] for r in counted])
    posterior = label_model(patterns, np.array([r["n"] for r in counted], float))
    by_votes = F.create_map(*(F.lit(x) for r, p in zip(counted, posterior, strict=True) for x in (r["votes"], float(p))))
    # Half of the sample from texts on which a voter fires, as far as there are any.
    draw = [
        voted.filter(part).orderBy("draw").limit(MAX_TRAINED // 2) for part in ("votes > 0", "votes = 0")
    ]
    drawn = draw[0].unionByName(draw[1]).select("id", by_votes[F.col("votes")].alias("label")).dropDuplicates(["id"])
    learned = stored(rows.join(F.broadcast(drawn), "id").select("text", "label"), "toxicity-sample")
    n, toxic = learned.agg(F.count("*"), F.sum("label")).first()
    base = (toxic + 0.5) / (n + 1)
    pull = F.abs(F.col("weight") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base) + 1)
    counts = _term_counts(learned).filter((F.col("n") >= LEAST_ROWS) & (pull >= LEAST_PULL))
    features = [r["term"] for r in counts.orderBy(pull.desc(), "term").limit(MAX_FEATURES).collect()]
    finder = Finder(features)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [sorted(finder(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.list_(pa.int32())), batch.column("label")], names=["hits", "label"])

    data = learned.mapInArrow(found, "hits array<int>, label double").toArrow()
    hits = [np.array(h, np.int64) for h in data.column("hits").to_pylist()]
    weights, intercept = _logistic(hits, data.column("label").to_numpy(), len(features))
    return Model(finder, weights, intercept)


def scored(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """All columns of `docs` but the text in `row`, with `score`."""
    kept = [c for c in docs.columns if c != text]
    kind = docs.select(*kept).schema.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [sent.value.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    rows = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row {kind}, score double")
