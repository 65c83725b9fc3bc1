"""Quality classifier: a sparse rule ensemble.

A random forest of shallow trees over text statistics proposes rules: each
path from a root is a conjunction of bounds. A lasso logistic regression over
the rules gives most of them weight zero; the rest are compiled into one
Spark column expression, so scoring needs no model object.

Both fits run on Spark over all labelled training rows. For the second one,
rows are first grouped by the rules they satisfy and their label (a few
thousand groups, weighted by their counts).

Defined cases: a null or empty text is scored from zero counts like any other;
null labels and labels other than 0 and 1 are left out, repeated labels of an
id count as the smallest; with labels of one class (or none) the score is the
share of label 1 (0.5 without labels) for every row; repeated rows each get a
result row, and extra input columns never meet the operator's own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .text_stats import COUNTS, features, with_counts

TREES = 24
DEPTH = 3
LASSO = 2e-4
SEED = 11


def held_out(key: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass(frozen=True)
class Rule:
    """Bounds per statistic: low < value <= high."""
    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        known = features()
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out = out & (known[name] > low)
            if high < math.inf:
                out = out & (known[name] <= high)
        return out


@dataclass(frozen=True)
class Model:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1, from the count columns."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def tree_rules(forest, names: list[str]) -> list[Rule]:
    """Every root path of every tree (to inner nodes and leaves) as a rule,
    each once. A path to a right child of a root is the complement of the left
    one and is left out."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float, float]], skip: bool) -> None:
        if bounds and not skip:
            found.setdefault(Rule(tuple((n, *bounds[n]) for n in sorted(bounds))))
        if node.subtreeDepth() == 0:
            return
        name, cut = names[node.split().featureIndex()], node.split().threshold()
        low, high = bounds.get(name, (-math.inf, math.inf))
        walk(node.leftChild(), bounds | {name: (low, min(high, cut))}, False)
        walk(node.rightChild(), bounds | {name: (max(low, cut), high)}, not bounds)

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {}, False)
    return list(found)


def fit(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Model:
    """``labelled``: the counts and ``quality`` (0 or 1)."""
    seen = {r.quality: r["count"] for r in labelled.groupBy("quality").count().collect()}
    if len(seen) < 2:
        share = (seen.get(1, 0) + 0.5) / (sum(seen.values()) + 1)
        return Model((), math.log(share / (1 - share)))
    x = features()
    rows = labelled.select(array_to_vector(F.array(*x.values())).alias("x"), F.col("quality").cast("double"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="quality", numTrees=trees, maxDepth=depth,
                                    featureSubsetStrategy="0.4", subsamplingRate=0.7, seed=SEED).fit(rows)
    rules = tree_rules(forest, list(x))
    groups = materialise(
        labelled.groupBy(F.array(*[r.column().cast("double") for r in rules]).alias("met"), "quality")
        .agg(F.count(F.lit(1)).cast("double").alias("weight")), "rule-groups")
    points = groups.select(array_to_vector("met").alias("x"), F.col("quality").cast("double"), "weight")
    lasso_fit = LogisticRegression(featuresCol="x", labelCol="quality", weightCol="weight", regParam=lasso,
                                   elasticNetParam=1.0, standardization=False, maxIter=60).fit(points)
    weights = lasso_fit.coefficients.toArray()
    return Model(tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6),
                 float(lasso_fit.intercept))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           keep_rows: bool = False) -> DataFrame:
    """Per row: ``row`` (the whole input row if ``keep_rows``, else its id),
    the counts, ``held_out``, ``score`` and ``predicted``."""
    source = docs if keep_rows else docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    stats = with_counts(source, text_col)
    if not keep_rows:
        stats = stats.select(F.struct(F.col("row")[id_col].alias(id_col)).alias("row"), *COUNTS)
    stats = materialise(stats, "classifier-stats")
    known = (labels.select(F.col(f"`{id_col}`").alias("key"), F.col("quality").cast("int").alias("quality"))
             .filter("key IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("key")))
             .groupBy("key").agg(F.min("quality").alias("quality")))
    labelled = materialise(stats.select(F.col("row")[id_col].alias("key"), *COUNTS).join(known, "key"),
                           "classifier-labelled")
    model = fit(labelled)
    return (stats.withColumn("held_out", held_out(F.col("row")[id_col])).withColumn("score", model.score())
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted as label 1, with their own columns only."""
    return scored(docs, labels, id_col, text_col, keep_rows=True).filter("predicted = 1").select("row.*")
