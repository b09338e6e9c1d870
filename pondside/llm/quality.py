"""Quality classifier: a sparse rule ensemble.

Shallow boosted trees are grown over text statistics; every path from a root is a conjunction of thresholds, a rule.
A logistic regression with lasso penalty weighs the rules and drops most of them; what is left becomes one column
expression, so scoring is a projection over the whole table.

The trees and weights are fitted on at most MAX_LABELLED labelled rows, drawn by hash; everything else
covers all rows.

Defined results: NULL and empty texts have all statistics 0 and are scored like others; labels other than 0 and 1 are
ignored; with no label to learn from every score is 0.5, with labels of one kind it is that kind's share with one
of each kind added; an empty table gives no rows. Other columns are carried along untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from pondside.llm.common import stored
from pondside.llm.labelled import sample
from pondside.llm.textstats import statistics

MAX_LABELLED = 20_000
TREES, DEPTH = 12, 3
PENALTY = 0.002
SEED = 5


@dataclass(frozen=True)
class Condition:
    statistic: str
    threshold: float
    above: bool

    def column(self) -> Column:
        value = F.col(f"stats.{self.statistic}")
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


@dataclass
class Ensemble:
    intercept: float
    weights: dict[Rule, float]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(fires(rule), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fires(rule: Rule) -> Column:
    met = F.lit(True)
    for condition in rule:
        met = met & condition.column()
    return met


def tree_rules(node, names: list[str], path: Rule = ()) -> list[Rule]:
    """The paths from the root to every other node, with one condition per statistic and side: the strictest."""
    found = [path] if path else []
    if node.subtreeDepth() == 0:
        return found
    split = node.split()
    name, threshold = names[split.featureIndex()], float(split.threshold())
    for child, above in ((node.leftChild(), False), (node.rightChild(), True)):
        same = [c for c in path if (c.statistic, c.above) == (name, above)]
        bound = (max if above else min)([threshold, *(c.threshold for c in same)])
        rest = tuple(c for c in path if c not in same)
        found += tree_rules(child, names, (*rest, Condition(name, bound, above)))
    return found


def train(docs: DataFrame, labels: DataFrame, identity: str, text: str, label: str) -> Ensemble:
    """Rules and weights from labelled rows of `docs`."""
    stats = statistics(F.col(f"row.{text}"))
    names = list(stats)
    drawn = sample(docs.select(identity, text), labels, identity, label, MAX_LABELLED)
    rows = stored(drawn.select(F.struct(*(c.alias(n) for n, c in stats.items())).alias("stats"), "label"), "quality-sample")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
        return Ensemble(math.log(share / (1 - share)), {})
    vectors = VectorAssembler(inputCols=names, outputCol="x").transform(rows.select("stats.*", "label"))
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.7)
    trees = trees.fit(vectors.coalesce(4))
    rules = list(dict.fromkeys(r for t in trees._call_java("trees") for r in tree_rules(t.rootNode(), names)))
    flags = rows.select("label", *(fires(r).cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    flags = VectorAssembler(inputCols=flags.columns[1:], outputCol="x").transform(stored(flags, "quality-rules"))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, standardization=False)
    lasso = lasso.fit(flags.select("x", "label").coalesce(4))
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients, strict=True) if w}
    return Ensemble(float(lasso.intercept), weights)


def scored(docs: DataFrame, model: Ensemble, text: str) -> DataFrame:
    """All columns of `docs` in `row`, with `score`."""
    stats = F.struct(*(c.alias(n) for n, c in statistics(F.col(text)).items()))
    return docs.select(F.struct(*docs.columns).alias("row"), stats.alias("stats")).select("row", model.score().alias("score"))
