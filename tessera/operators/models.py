"""Classifiers on feature vectors: MLlib's, linear machines, nearest means.

Input frames have class_id and an array column `vector`; predictions come back as a
column `prediction` next to the input columns.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tessera.operators import machines, stats
from tessera.session import settle

Predict = Callable[[DataFrame], DataFrame]

# Penalty of the linear support vector machine.
SVC_PENALTY = 0.005


def as_ml(df: DataFrame, vector: str = "vector") -> DataFrame:
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return df.withColumn("features", dense).withColumn("label", F.col("class_id").cast("double"))


def scaled_pair(train: DataFrame, test: DataFrame, vector: str = "vector") -> tuple[DataFrame, DataFrame]:
    """Both frames scaled with the moments of the training rows alone."""
    moments = settle(stats.vector_moments(train, vector))
    return tuple(stats.scale_by(df, vector, moments, vector) for df in (train, test))


def _predictor(model) -> Predict:
    extra = ["features", "label", "rawPrediction"]
    return lambda df: model.transform(as_ml(df)).drop(*extra)


def logistic(max_iter: int = 50, reg: float = 0.0) -> Callable[[DataFrame], Predict]:
    """Softmax regression."""

    def fit(train: DataFrame) -> Predict:
        estimator = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg)
        return _predictor(estimator.fit(as_ml(train)))

    return fit


def perceptron(hidden: list[int], classes: int, max_iter: int = 50, seed: int = 42) -> Callable[[DataFrame], Predict]:
    """Dense layers with a softmax on top."""

    def fit(train: DataFrame) -> Predict:
        width = train.select(F.size("vector")).first()[0]
        estimator = MultilayerPerceptronClassifier(layers=[width, *hidden, classes], maxIter=max_iter, seed=seed)
        return _predictor(estimator.fit(as_ml(train)))

    return fit


def svc_one_vs_rest(penalty: float = SVC_PENALTY, max_iter: int = 100) -> Callable[[DataFrame], Predict]:
    """One linear machine per class against all others, on scaled columns; the farthest inside wins."""
    return _svc(machines.one_vs_rest, machines.nearest_sides, penalty, max_iter)


def svc_one_vs_one(penalty: float = SVC_PENALTY, max_iter: int = 100) -> Callable[[DataFrame], Predict]:
    """One linear machine per pair of classes; most votes win, the lower class on a tie."""
    return _svc(machines.one_vs_one, machines.most_votes, penalty, max_iter)


def _svc(make: Callable, decide: Callable, penalty: float, max_iter: int) -> Callable[[DataFrame], Predict]:
    def fit(train: DataFrame) -> Predict:
        stored = train.select("class_id", "vector").persist()
        try:
            found = machines.fit_machines(stored, lambda classes: make(classes, penalty), max_iter=max_iter)
        finally:
            stored.unpersist()
        return machines.predictor(found, decide, train.sparkSession)

    return fit


def _class_sums(train: DataFrame, vector: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes, their rows and their sums of whole numbers by position; one line a class comes to the driver."""
    lines = train.groupBy("class_id").agg(F.count("*").alias("n"), F.array(*[F.sum(F.get(vector, F.lit(i)).cast("bigint")) for i in range(width)]).alias("sums"))
    rows = lines.where("class_id IS NOT NULL").orderBy("class_id").collect()
    return tuple(np.array([r[c] for r in rows], np.int64) for c in ("class_id", "n", "sums"))


def subset_means(train: DataFrame, width: int, parts: list[tuple[int, int]], subsets: list[list[int]], vector: str = "vector") -> Callable[[DataFrame], DataFrame]:
    """Fits the nearest class mean; returns a function that adds `predictions`, one class for each subset of the parts.

    Vectors hold whole numbers, so the distances, which add up over the parts (from, to), are exact: one pass
    over the training rows and one over the others serve all subsets. Equal distances go to the lower class.
    """
    classes, n, sums = _class_sums(train, vector, width)
    member = np.array([[p in chosen for p in range(len(parts))] for chosen in subsets], np.int64)
    bank = train.sparkSession.sparkContext.broadcast((classes, n, sums))

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def predict(vectors: pa.Array) -> pa.Array:
        classes, n, sums = bank.value
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.int64)
        out = np.empty((len(flat), len(member)), np.int32)
        for a in range(0, len(flat), 256):
            gaps = (n[None, :, None] * flat[a : a + 256, None, :] - sums[None]) ** 2
            far = np.stack([gaps[:, :, x:y].sum(axis=2) for x, y in parts], axis=2) @ member.T
            out[a : a + 256] = classes[(far / (n * n)[None, :, None].astype(float)).argmin(axis=1)]
        return pa.array(list(out), pa.list_(pa.int32()))

    return lambda df: df.withColumn("predictions", predict(vector))


def nearest_mean(width: int, parts: list[tuple[int, int]], vector: str = "vector") -> Callable[[DataFrame], Predict]:
    """The nearest class mean over some parts of the vector, as a fit for grid_search."""

    def fit(train: DataFrame) -> Predict:
        predict = subset_means(train, width, parts, [list(range(len(parts)))], vector)
        return lambda df: predict(df).withColumn("prediction", F.get("predictions", F.lit(0))).drop("predictions")

    return fit


def grid_search(
    train: DataFrame, candidates: dict[str, Callable[[DataFrame], Predict]], fold: str, folds: int, threads: int = 4
) -> DataFrame:
    """Accuracy of every candidate in every fold and its mean; fold is a column 0..folds-1."""
    spark = train.sparkSession
    stored = train.persist()

    def run(task: tuple[str, int]):
        name, k = task
        predict = candidates[name](stored.where(F.col(fold) != k))
        hit = (F.col("prediction") == F.col("class_id")).cast("double")
        return name, k, predict(stored.where(F.col(fold) == k)).agg(F.avg(hit)).first()[0]

    try:
        with ThreadPoolExecutor(threads) as pool:
            lines = list(pool.map(run, [(name, k) for name in candidates for k in range(folds)]))
    finally:
        stored.unpersist()
    scores = spark.createDataFrame(lines, "candidate string, fold int, accuracy double")
    mean = F.avg("accuracy").over(Window.partitionBy("candidate"))
    return scores.withColumn("mean_accuracy", mean)


def model_loss(predicted: DataFrame) -> DataFrame:
    """Log loss and accuracy of a model that gives probabilities, and the square root of both."""
    chance = F.get(vector_to_array("probability"), F.col("class_id"))
    hit = (F.col("prediction") == F.col("class_id")).cast("double")
    scored = predicted.agg(
        F.avg(-F.log(F.greatest(chance, F.lit(1e-7)))).alias("loss"), F.avg(hit).alias("accuracy")
    )
    return scored.select(
        "loss", "accuracy", F.sqrt("loss").alias("root_loss"), F.sqrt("accuracy").alias("root_accuracy")
    )
