"""Gaussian naive Bayes: one grouped aggregate, scoring as a projection."""

from __future__ import annotations

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed, vectors
from tabml.operators.learners.base import FittedModel, class_count, vector, width, with_class_scores


class BayesModel(FittedModel):
    kind = "naiveBayes"
    has_probability = True

    def __init__(self, priors: np.ndarray, means: np.ndarray, variances: np.ndarray):
        super().__init__(list(means.std(axis=0)))
        self.priors, self.means, self.variances = priors, means, variances

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scores = [
            vectors.gaussian_log_score(F.col("features"), p, list(m), list(v))
            for p, m, v in zip(self.priors, self.means, self.variances)
        ]
        return with_class_scores(dataset, scores)

    def parameters_table(self, spark) -> DataFrame:
        """`(class_index, position, prior, mean, variance)`."""
        rows = [
            (c, j, float(self.priors[c]), float(self.means[c, j]), float(self.variances[c, j]))
            for c in range(len(self.priors))
            for j in range(self.means.shape[1])
        ]
        return spark.createDataFrame(rows, "class_index bigint, position bigint, prior double, mean double, variance double")


def train_bayes(df: DataFrame, classes: int | None = None) -> BayesModel:
    count, d = classes or class_count(df), width(df)
    summary = Summarizer.metrics("mean", "variance", "count").summary(vector()).alias("s")
    rows = df.groupBy("label").agg(summary).collect()
    n = sum(r["s"]["count"] for r in rows)
    priors = np.full(count, fixed.BAYES_PRIOR_FLOOR)
    means, variances = np.zeros((count, d)), np.full((count, d), fixed.BAYES_VARIANCE_FLOOR)
    for r in rows:
        c, size = int(r["label"]), r["s"]["count"]
        priors[c] = size / n
        means[c] = r["s"]["mean"].toArray()
        if size > 1:
            population = r["s"]["variance"].toArray() * (size - 1) / size
            variances[c] = np.maximum(population, fixed.BAYES_VARIANCE_FLOOR)
    return BayesModel(priors, means, variances)
