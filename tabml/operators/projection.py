"""Two-dimensional projection on the leading directions of the covariance."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed, vectors
from tabml.operators.gram import gram
from tabml.operators.learners.base import width


class Projection:
    """Means and two directions; `transform` adds `pc1` and `pc2`."""

    def __init__(self, means: np.ndarray, directions: np.ndarray, eigenvalues: tuple[float, float]):
        self.means, self.directions, self.eigenvalues = means, directions, eigenvalues

    def transform(self, df: DataFrame) -> DataFrame:
        if len(self.means) == 1:
            return df.withColumn("pc1", F.col("features")[0]).withColumn("pc2", F.lit(0.0))
        for name, direction in zip(("pc1", "pc2"), self.directions):
            offset = float(np.dot(self.means, direction))
            df = df.withColumn(name, vectors.dot(F.col("features"), direction) - F.lit(offset))
        return df


def fit_pca(df: DataFrame) -> Projection:
    """One aggregate for means and covariance; the power steps run on that small matrix."""
    d = width(df)
    products = gram(df, F.concat(F.array(F.lit(1.0)), F.col("features")), d + 1)
    n = products[0, 0]
    means = products[0, 1:] / n
    covariance = products[1:, 1:] / n - np.outer(means, means)
    first = _leading(covariance)
    strength = float(first @ covariance @ first)
    rest = covariance - strength * np.outer(first, first)
    second = _leading(rest)
    return Projection(means, np.array([first, second]), (strength, float(second @ rest @ second)))


def _leading(matrix: np.ndarray) -> np.ndarray:
    direction = np.full(len(matrix), fixed.PCA["rest"])
    direction[0] = fixed.PCA["first"]
    for _ in range(fixed.PCA["steps"]):
        moved = matrix @ direction
        direction = moved / (np.linalg.norm(moved) or 1.0)
    return direction
