"""Gradient-boosted trees: fitted by Spark ML, scored as a plain SQL expression."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tree = float | tuple  # a leaf, or (feature, threshold, left, right)


def fit(rows: DataFrame, features: Sequence[str], label: str, trees: int = 12, depth: int = 3) -> list[tuple[float, Tree]]:
    """Weighted trees fitted on ``rows``; with a single class, one constant leaf."""
    kinds = {r[0] for r in rows.select(F.col(label).cast("double")).distinct().collect()}
    if len(kinds) < 2:
        return [(1.0, 4.0 if kinds == {1.0} else -4.0)]
    vectors = VectorAssembler(inputCols=list(features), outputCol="__x", handleInvalid="keep").transform(
        rows.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("__y")))
    model = GBTClassifier(featuresCol="__x", labelCol="__y", maxIter=trees, maxDepth=depth, maxBins=32,
                          stepSize=0.3, seed=7).fit(vectors)

    def read(node) -> Tree:
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        return features[split.featureIndex()], float(split.threshold()), read(node.leftChild()), read(node.rightChild())

    return [(float(w), read(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees)]


def probability(model: list[tuple[float, Tree]], feature: Callable[[str], Column]) -> Column:
    """P(label = 1) as nested CASE expressions over ``feature(name)``."""
    def case(node: Tree) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        name, at, left, right = node
        return F.when(feature(name) <= F.lit(at), case(left)).otherwise(case(right))

    margin = F.lit(0.0)
    for weight, tree in model:
        margin = margin + F.lit(weight) * case(tree)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
