"""K-Means: Lloyd rounds from drawn rows or given centres."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabml.functions import fixed, vectors
from tabml.functions.values import col
from tabml.operators.learners.base import FittedModel, dispersion, vector
from tabml.operators.sampling import key_hash
from tabml.sources.rows import ROW_ID


def cluster_number(k: int | None) -> int:
    """The given number of clusters, or the default."""
    number = fixed.KMEANS["k"] if k is None else k
    if number < 1:
        raise ValueError("k must be at least 1.")
    return number


def with_nearest_center(df: DataFrame, centers: np.ndarray, name: str) -> DataFrame:
    """Add the index of the closest centre, the lowest on ties."""
    away = F.array(*[vectors.squared_distance_to(F.col("features"), c) for c in centers])
    return df.withColumn("_away", away).withColumn(name, vectors.argmin(F.col("_away"))).drop("_away")


class KMeansModel(FittedModel):
    kind = "kmeans"

    def __init__(self, centers: np.ndarray, importances: list[float], rounds: int | None = None):
        super().__init__(importances, {"k": len(centers), "rounds": rounds})
        self.centers = np.asarray(centers, dtype=float)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_nearest_center(dataset, self.centers, "prediction")

    def centers_table(self, spark) -> DataFrame:
        rows = [(c, j, float(v)) for c, row in enumerate(self.centers) for j, v in enumerate(row)]
        return spark.createDataFrame(rows, "cluster bigint, position bigint, center double")

    def inertia(self, df: DataFrame) -> DataFrame:
        """`(inertia)`: summed squared distance to the assigned centre."""
        away = F.array_min(F.array(*[vectors.squared_distance_to(F.col("features"), c) for c in self.centers]))
        return df.agg(F.coalesce(F.sum(away), F.lit(0.0)).alias("inertia"))


def train_kmeans(
    df: DataFrame, k: int | None = None, init_centers: Sequence[Sequence[float]] | None = None, method: str = "rows",
    key: str = ROW_ID, rounds: int = fixed.KMEANS["rounds"], seed: int = fixed.KMEANS["seed"],
) -> KMeansModel:
    """Lloyd rounds from given centres, or from k rows drawn by the hash of their unique `key`.

    `method="spark"` uses Spark's learner, whose random start depends on the partitioning.
    """
    spread = dispersion(df)
    if init_centers is None and method == "spark":
        learner = KMeans(featuresCol="_vector", k=cluster_number(k), maxIter=rounds, tol=0.0, initMode="random", seed=seed)
        fitted = learner.fit(df.select(vector().alias("_vector")))
        return KMeansModel(np.array(fitted.clusterCenters()), spread, fitted.summary.numIter)
    if init_centers is None:
        drawn = df.orderBy(key_hash(seed, key), col(key)).select("features").limit(cluster_number(k)).collect()
        init_centers = [r["features"] for r in drawn]
    return lloyd(df, np.array(init_centers, dtype=float), rounds, spread)


def lloyd(df: DataFrame, centers: np.ndarray, rounds: int, spread: list[float]) -> KMeansModel:
    """Each round is one aggregate with k result rows; an empty cluster keeps its centre."""
    data = df.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    done = 0
    try:
        for done in range(1, rounds + 1):
            means = with_nearest_center(data, centers, "c").groupBy("c").agg(Summarizer.mean(vector()).alias("m")).collect()
            moved = centers.copy()
            for r in means:
                moved[int(r["c"])] = r["m"].toArray()
            settled = np.array_equal(moved, centers)
            centers = moved
            if settled:
                break
    finally:
        data.unpersist()
    return KMeansModel(centers, spread, done)
