"""Distance-weighted nearest neighbours for classes and numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions import fixed, vectors
from tabml.functions.values import col
from tabml.operators import neighbors
from tabml.operators.learners.base import FittedModel, class_count, dispersion
from tabml.sources.rows import ROW_ID
from tabml.sources.scratch import checkpointed


def neighbor_count(n: int) -> int:
    """Square root of the training rows, half up, within the fixed limits."""
    return min(fixed.KNN_MAX, max(fixed.KNN_MIN, int(np.floor(n**0.5 + 0.5))))


class KnnModel(FittedModel):
    """Keeps a reference to the training rows; `key` names the unique id of rows to score.

    A small training side is searched inside one projection, which also works on streams. A larger
    one is joined through `nearest_neighbors`, under numbers of its own for the rows to score, so that both
    ways return every row, whatever its key; a stream needs the small side.
    """

    def __init__(self, train: DataFrame, key: str, classes: int | None, small_bytes: int | None = None):
        super().__init__(dispersion(train))
        self.kind = "knnClassifier" if classes else "knnRegressor"
        self.has_probability = bool(classes)
        self.train, self.key, self.classes = train.select(col(key), "features", "label"), key, classes
        n = self.train.count()
        self.k = neighbor_count(n)
        self.details = {"k": self.k}
        limit = neighbors.SMALL_BYTES if small_bytes is None else small_bytes
        self.small_bytes, self.small = small_bytes, n * (len(self.importances) + 2) * 8 <= limit

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._narrow(dataset) if self.small else self._joined(dataset)

    def _narrow(self, dataset: DataFrame) -> DataFrame:
        side = self.train.select(col(self.key).cast("bigint").alias("tid"), F.col("features").alias("tf"), "label")
        held = dataset.sparkSession.sparkContext.broadcast(neighbors.SmallTrainingSet(side, self.k))
        k, classes = self.k, self.classes

        @F.pandas_udf("array<double>")
        def vote(features: pd.Series) -> pd.Series:
            data = held.value
            if not len(features):
                return pd.Series([], dtype=object)
            row, point, distance = data.nearest(neighbors._matrix(features), k)
            weight = 1.0 / (distance + fixed.KNN_OFFSET)
            label = data.labels[point]
            totals = np.bincount(row, weight, len(features))
            if classes is None:
                return pd.Series(list((np.bincount(row, weight * label, len(features)) / totals)[:, None]))
            votes = np.zeros((len(features), classes))
            np.add.at(votes, (row, label.astype(int)), weight)
            return pd.Series(list(votes / totals[:, None]))

        if classes is None:
            return dataset.withColumn("prediction", vote("features")[0])
        return dataset.withColumn("probability", vote("features")).withColumn("prediction", vectors.argmax(F.col("probability")))

    def _joined(self, dataset: DataFrame) -> DataFrame:
        numbered = checkpointed(dataset.withColumn("_scored", F.monotonically_increasing_id()))
        found = neighbors.nearest_neighbors(numbered, self.train, self.k, "_scored", self.key, "label", small_bytes=self.small_bytes)
        weight = 1 / (F.col("distance") + fixed.KNN_OFFSET)
        if self.classes is None:
            value = F.sum(weight * F.col("neighbor_label")) / F.sum(weight)
            scored = found.groupBy("_scored").agg(value.alias("prediction"))
        else:
            votes = [F.coalesce(F.sum(F.when(F.col("neighbor_label") == c, weight)), F.lit(0.0)) for c in range(self.classes)]
            scored = (
                found.groupBy("_scored")
                .agg(F.array(*votes).alias("_votes"))
                .select("_scored", vectors.normalized(F.col("_votes")).alias("probability"))
                .withColumn("prediction", vectors.argmax(F.col("probability")))
            )
        return numbered.join(scored, "_scored", "left").drop("_scored")


def train_knn_classifier(df: DataFrame, classes: int | None = None, key: str = ROW_ID, small_bytes: int | None = None) -> KnnModel:
    return KnnModel(df, key, classes or class_count(df), small_bytes)


def train_knn_regressor(df: DataFrame, key: str = ROW_ID, small_bytes: int | None = None) -> KnnModel:
    return KnnModel(df, key, None, small_bytes)
