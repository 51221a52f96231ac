"""A fitted boosted-tree model as plain column expressions, and as SQL text.

Every tree becomes nested comparisons of its features, the ensemble their weighted sum, and the
probability of class 1 the logistic function of twice that sum, as Spark ML's boosted trees
have it. The expressions need no ML library, no vectors and no Python where they run, the scan
reads the used features only, and another engine scores the same rows from the same text.
A missing feature (null or NaN) takes the right branch, as the assembled vector's NaN does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """``feature`` <= ``threshold`` goes left."""

    feature: str
    threshold: float
    left: Split | float
    right: Split | float


@dataclass(frozen=True)
class Ensemble:
    trees: Sequence[Split | float]
    weights: Sequence[float]

    def features(self) -> set[str]:
        """Features that some tree asks for."""
        found, todo = set(), list(self.trees)
        while todo:
            node = todo.pop()
            if isinstance(node, Split):
                found.add(node.feature)
                todo += [node.left, node.right]
        return found


def export(model: PipelineModel, feature_cols: Sequence[str]) -> Ensemble:
    """The trees of a pipeline whose last stage is a boosted-tree classifier; bounded by its depth and number of trees."""
    def walk(node) -> Split | float:
        if node.subtreeDepth() == 0:
            return float(node.prediction())
        split = node.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("only numeric splits can be compiled")
        return Split(feature_cols[split.featureIndex()], float(split.threshold()), walk(node.leftChild()), walk(node.rightChild()))

    last = model.stages[-1]
    return Ensemble([walk(t._call_java("rootNode")) for t in last.trees], [float(w) for w in last.treeWeights])


def _fold(node: Split | float, branch: Callable, leaf: Callable):
    if isinstance(node, Split):
        return branch(node, _fold(node.left, branch, leaf), _fold(node.right, branch, leaf))
    return leaf(node)


def probability(ensemble: Ensemble) -> Column:
    """Probability of class 1 as a column expression."""
    def branch(node: Split, left: Column, right: Column) -> Column:
        return F.when(F.col(node.feature).cast("double") <= F.lit(node.threshold), left).otherwise(right)

    trees = [_fold(t, branch, F.lit) * F.lit(w) for t, w in zip(ensemble.trees, ensemble.weights)]
    margin = sum(trees[1:], trees[0])
    return F.lit(1.0) / (1.0 + F.exp(-2.0 * margin))


def probability_sql(ensemble: Ensemble) -> str:
    """The same as SQL text, every number as an exact double."""
    def number(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"

    def branch(node: Split, left: str, right: str) -> str:
        # NaN is above all numbers in some engines and equal to none in others
        asked = f"CAST({node.feature} AS DOUBLE)"
        return f"CASE WHEN {asked} <= {number(node.threshold)} AND NOT isnan({asked}) THEN {left} ELSE {right} END"

    trees = [f"{_fold(t, branch, number)} * {number(w)}" for t, w in zip(ensemble.trees, ensemble.weights)]
    return f"1.0 / (1.0 + exp(-2.0 * ({' + '.join(trees)})))"


def score(ensemble: Ensemble, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, probability of class 1 and the thresholded class, as ``model.score`` gives them."""
    return df.select(*keep, probability(ensemble).alias("probability")).withColumn("prediction", (F.col("probability") >= threshold).cast("int"))
