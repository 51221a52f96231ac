"""Spark ML training and scoring.

Models are Spark ML pipelines (assembler + estimator): training is
distributed by Spark ML, scoring is ``transform`` (a narrow map stage), and
cross-validation uses the stratified fold column from ``split.stratified_folds``
so fold membership is repeatable.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwatch.operators.evaluate import roc_auc
from cohortwatch.session import cut_lineage

FEATURES = "features"


def _pipeline(feature_cols: Sequence[str], estimator, scale: bool = False) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(feature_cols), outputCol="__raw" if scale else FEATURES,
                              handleInvalid="keep")]
    if scale:
        stages.append(MinMaxScaler(inputCol="__raw", outputCol=FEATURES))
    stages.append(estimator)
    return Pipeline(stages=stages)


def candidates(label: str, seed: int) -> dict:
    """The algorithm set compared by the leaderboard."""
    return {
        "logistic_regression": (LogisticRegression(labelCol=label, featuresCol=FEATURES, maxIter=50), False),
        "decision_tree": (DecisionTreeClassifier(labelCol=label, featuresCol=FEATURES, seed=seed), False),
        "random_forest": (RandomForestClassifier(labelCol=label, featuresCol=FEATURES, seed=seed, numTrees=30), False),
        "gbt": (GBTClassifier(labelCol=label, featuresCol=FEATURES, seed=seed, maxIter=20), False),
        "linear_svc": (LinearSVC(labelCol=label, featuresCol=FEATURES, maxIter=50), False),
        # Gaussian naive Bayes: real-valued features, no scaling needed
        "naive_bayes": (NaiveBayes(labelCol=label, featuresCol=FEATURES, modelType="gaussian"), False),
    }


def train_gbt(df: DataFrame, feature_cols: Sequence[str], label: str, seed: int = 42, max_iter: int = 20) -> PipelineModel:
    """Boosted trees with default depth, seeded."""
    est = GBTClassifier(labelCol=label, featuresCol=FEATURES, seed=seed, maxIter=max_iter)
    return _pipeline(feature_cols, est).fit(df)


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Probability of class 1 and the thresholded class."""
    out = model.transform(df)
    p1 = vector_to_array(F.col("probability"))[1]
    return out.select(*keep, p1.alias("probability"), (p1 >= threshold).cast("int").alias("prediction"))


def batch_summary(scored: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Rows and positive ratio per batch; an empty batch gives n = 0 and a null ratio."""
    keys = [batch_col] if batch_col else []
    return scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col("prediction").cast("double")).alias("positive_ratio"))


def _parallelism(df: DataFrame, parallelism: int | None) -> int:
    return parallelism or max(2, df.sparkSession.sparkContext.defaultParallelism)


def cross_scores(df: DataFrame, feature_cols: Sequence[str], label: str, fold_col: str, n_folds: int, estimators: Mapping[str, tuple],
                 parallelism: int | None = None) -> DataFrame:
    """(model, fold, label, score): every row scored by each estimator's fit on the other folds.

    Features are assembled once and written; the fits of all estimators and folds run
    ``parallelism`` at a time (default: the cluster's default parallelism), and what they score
    is one table, so that all metrics of all of them are one grouped job. Each fold's rows are
    written by themselves as well, so that a fit scores its fold without reading the others.
    """
    vectors = VectorAssembler(inputCols=list(feature_cols), outputCol="__raw", handleInvalid="keep").transform(df)
    vectors = cut_lineage(vectors.select(F.col(label).cast("double").alias(label), F.col(fold_col).alias("fold"), "__raw"))
    held = [cut_lineage(vectors.where(F.col("fold") == fold)) for fold in range(n_folds)]

    def scored(job):
        name, (est, scale), fold = job
        stages = [MinMaxScaler(inputCol="__raw", outputCol=FEATURES)] if scale else []
        est = est.copy({est.featuresCol: FEATURES if scale else "__raw"})
        model = Pipeline(stages=[*stages, est]).fit(vectors.where(F.col("fold") != fold))
        raw = vector_to_array(F.col("rawPrediction"))[1]
        return model.transform(held[fold]).select(
            F.lit(name).alias("model"), "fold", F.col(label).cast("int").alias("label"), raw.alias("score"))

    jobs = [(name, est, fold) for name, est in estimators.items() for fold in range(n_folds)]
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), _parallelism(df, parallelism)))) as pool:
        return reduce(DataFrame.unionByName, pool.map(scored, jobs))


def cross_metrics(scores: DataFrame) -> DataFrame:
    """(model, auc, auc_std, n_folds): mean and deviation of the AUC over the folds of ``cross_scores``."""
    per_fold = roc_auc(cut_lineage(scores), "label", "score", by=["model", "fold"])
    return per_fold.groupBy("model").agg(F.avg("auc").alias("auc"), F.stddev_pop("auc").alias("auc_std"), F.count("auc").alias("n_folds"))


def leaderboard(df: DataFrame, feature_cols: Sequence[str], label: str, fold_col: str, n_folds: int,
                seed: int = 42, parallelism: int | None = None, models: Sequence[str] | None = None) -> DataFrame:
    """Mean cross-validated AUC per candidate over the given folds, best first."""
    chosen = {name: c for name, c in candidates(label, seed).items() if not models or name in models}
    scores = cross_scores(df, feature_cols, label, fold_col, n_folds, chosen, parallelism)
    return cross_metrics(scores).select("model", "auc", "auc_std").orderBy(F.desc("auc"), "model")


def random_search(df: DataFrame, feature_cols: Sequence[str], label: str, fold_col: str, n_folds: int, grid: dict,
                  n_iter: int = 25, seed: int = 42, parallelism: int | None = None) -> tuple[DataFrame, dict]:
    """Seeded draws from a grid, cross-validated; keep the untuned model if no draw beats it.

    Returns the per-draw table (draw, params, auc) and the chosen parameters. Draws that are the same
    model share its fits: equal ones, and those that differ in how no penalty is shared out.
    """
    rng = random.Random(seed)
    est = LogisticRegression(labelCol=label, featuresCol=FEATURES)
    keys = sorted(grid)
    draws = [{}] + [{k: rng.choice(grid[k]) for k in keys} for _ in range(n_iter)]
    same: dict[tuple, list[int]] = {}
    for i, d in enumerate(draws):
        unpenalised = d.get("regParam", est.getRegParam()) == 0.0
        same.setdefault(tuple((k, v) for k, v in d.items() if not (unpenalised and k == "elasticNetParam")), []).append(i)
    tuned = {str(of[0]): (est.copy({getattr(est, k): v for k, v in draws[of[0]].items()}), False) for of in same.values()}
    metrics = cross_metrics(cross_scores(df, feature_cols, label, fold_col, n_folds, tuned, parallelism))
    fitted = {int(r["model"]): float(r["auc"]) for r in metrics.collect()}  # one row a model
    auc = {i: fitted[of[0]] for of in same.values() for i in of}
    best = max(auc, key=lambda i: (auc[i], -i))
    rows = [(i, ", ".join(f"{k}={d[k]}" for k in keys) if i else "untuned", auc[i]) for i, d in enumerate(draws)]
    return df.sparkSession.createDataFrame(rows, "draw int, params string, auc double"), draws[best]


def feature_importance(model: PipelineModel, feature_cols: Sequence[str], spark: SparkSession) -> DataFrame:
    """Importances zipped with input names, largest first."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(feature_cols, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def save_load(model: PipelineModel, path: str) -> PipelineModel:
    """Write to shared storage and read back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
