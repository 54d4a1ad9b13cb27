"""One entry point for all learners."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabml.functions import fixed
from tabml.operators.learners.base import FittedModel
from tabml.operators.learners.bayes import train_bayes
from tabml.operators.learners.dbscan import train_dbscan
from tabml.operators.learners.kmeans import train_kmeans
from tabml.operators.learners.knn import train_knn_classifier, train_knn_regressor
from tabml.operators.learners.linear import train_linear
from tabml.operators.learners.softmax import train_softmax
from tabml.operators.learners.trees import train_forest, train_tree

LEARNERS = {
    "logistic": train_softmax,
    "knnClassifier": train_knn_classifier,
    "naiveBayes": train_bayes,
    "treeClassifier": lambda df, **o: train_tree(df, "classification", **o),
    "forestClassifier": lambda df, **o: train_forest(df, "classification", **o),
    "linearRegression": train_linear,
    "knnRegressor": train_knn_regressor,
    "treeRegressor": lambda df, **o: train_tree(df, "regression", **o),
    "forestRegressor": lambda df, **o: train_forest(df, "regression", **o),
    "kmeans": train_kmeans,
    "dbscan": train_dbscan,
}


def train(problem_type: str, algorithm: str, df: DataFrame, **options) -> FittedModel:
    """Fit `algorithm` on `features` (and `label`) of `df`."""
    if algorithm not in fixed.ALGORITHMS.get(problem_type, ()):
        raise ValueError(f"Unsupported algorithm: {algorithm}")
    if df.isEmpty():
        raise ValueError("No training rows are available.")
    return LEARNERS[algorithm](df, **options)
