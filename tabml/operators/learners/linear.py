"""Linear regression: one aggregate for the Gram matrix, then small matrix steps on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed, vectors
from tabml.operators.gram import gram
from tabml.operators.learners.base import FittedModel, width


class LinearModel(FittedModel):
    kind = "linearRegression"

    def __init__(self, weights: np.ndarray, mean: float, std: float):
        super().__init__(list(np.abs(weights[1:])), {"y_mean": mean, "y_std": std})
        self.weights, self.mean, self.std = [float(w) for w in weights], mean, std

    def _transform(self, dataset: DataFrame) -> DataFrame:
        score = F.lit(self.weights[0]) + vectors.dot(F.col("features"), self.weights[1:])
        return dataset.withColumn("prediction", score * F.lit(self.std) + F.lit(self.mean))

    def contributions(self) -> Column:
        scaled = vectors.array_literal(self.weights[1:])
        return F.zip_with(F.col("features"), scaled, lambda x, w: F.abs(w * x * F.lit(self.std)))

    def weights_table(self, spark) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.weights)), "position bigint, weight double")


def train_linear(df: DataFrame, solver: str = "gd", rate: float = fixed.LINEAR["rate"], epochs: int = fixed.LINEAR["epochs"], l2: float = fixed.LINEAR["l2"]) -> LinearModel:
    """`gd` takes a fixed number of gradient steps; `ridge` solves for their limit.

    The gradient over all rows is a function of the Gram matrix alone, so the data is read once
    whatever the number of steps.
    """
    d = width(df)
    row = df.agg(F.avg("label").alias("m"), F.stddev_pop("label").alias("s"), F.count("label").alias("n")).first()
    mean, std, n = row["m"], row["s"] or 1.0, row["n"]
    scaled = (F.col("label") - F.lit(mean)) / F.lit(std)
    products = gram(df, F.concat(F.array(F.lit(1.0)), F.col("features"), F.array(scaled)), d + 2)
    a, b = products[: d + 1, : d + 1] / n, products[: d + 1, d + 1] / n
    penalty = np.full(d + 1, l2)
    penalty[0] = 0.0
    if solver == "ridge":
        return LinearModel(np.linalg.lstsq(a + np.diag(penalty), b, rcond=None)[0], mean, std)
    step = np.eye(d + 1) - rate * (a + np.diag(penalty))
    weights = np.zeros(d + 1)
    for _ in range(epochs):
        weights = step @ weights + rate * b
    return LinearModel(weights, mean, std)
