"""Softmax regression: a fixed number of full-batch gradient steps, or the converged solution."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabml.functions import fixed, vectors
from tabml.operators.learners.base import FittedModel, class_count, vector, width, with_class_scores

# Rows per matrix in gradient steps.
BLOCK_ROWS = 8192
# Up to so many products a step (distinct rows x features x classes) all steps run in one task: some 32 MB of rows at most, and
# a step takes less time than a job.
ONE_TASK = 4_000_000
# Bytes of kept matrices per task at most, where these are more than the cores can hold in one part each.
PART_BYTES = 256 << 20


class SoftmaxModel(FittedModel):
    kind = "softmaxRegression"
    has_probability = True

    def __init__(self, weights: np.ndarray):
        super().__init__(list(np.abs(weights[:, 1:]).sum(axis=0)), {"classes": len(weights)})
        self.weights = np.asarray(weights, dtype=float)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scores = [F.lit(float(w[0])) + vectors.dot(F.col("features"), w[1:]) for w in self.weights]
        return with_class_scores(dataset, scores)

    def contributions(self) -> Column:
        rows = vectors.array_literal([list(w[1:]) for w in self.weights])
        own = F.element_at(rows, F.col("prediction").cast("int") + 1)
        return F.zip_with(F.col("features"), own, lambda x, w: F.abs(w * x))

    def weights_table(self, spark) -> DataFrame:
        rows = [(c, j, float(w)) for c, row in enumerate(self.weights) for j, w in enumerate(row)]
        return spark.createDataFrame(rows, "class_index bigint, position bigint, weight double")


def train_softmax(
    df: DataFrame, classes: int | None = None, solver: str = "gd",
    rate: float = fixed.SOFTMAX["rate"], epochs: int = fixed.SOFTMAX["epochs"], l2: float = fixed.SOFTMAX["l2"],
) -> SoftmaxModel:
    """`gd` stops after `epochs` steps from zero; `converged` minimises the same penalised loss.

    A gradient step needs a pass over the kept matrices. For very large data `converged` takes fewer
    passes, but its probabilities are sharper than those of the unfinished descent.
    """
    count = classes or class_count(df)
    d = width(df)
    if solver == "gd":
        return SoftmaxModel(_descend(df, count, d, rate, epochs, l2))
    learner = LogisticRegression(
        featuresCol="_vector", labelCol="label", family="multinomial", regParam=l2, elasticNetParam=0.0,
        standardization=False, maxIter=500, tol=1e-9,
    )
    fitted = learner.fit(df.select("label", vector().alias("_vector")))
    weights = np.column_stack([fitted.interceptVector.toArray(), fitted.coefficientMatrix.toArray()])
    # Trailing classes without a training row have no weights of their own.
    if len(weights) < count:
        weights = np.vstack([weights, np.zeros((count - len(weights), d + 1))])
    return SoftmaxModel(weights)


def _descend(df: DataFrame, count: int, d: int, rate: float, epochs: int, l2: float) -> np.ndarray:
    """Full-batch steps over distinct rows with weights: all in one task where these are few.

    Else a step is a job of a single stage over the kept blocks, in about as many tasks as there are cores: each task
    adds up its blocks, and the few partial gradients (classes x features numbers) are added in the order of the tasks.
    """
    spark = df.sparkSession
    weighted = df.groupBy("features", F.col("label").cast("double").alias("label")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
    penalty = np.full(d + 1, l2)
    penalty[0] = 0.0

    # Rows are packed into blocks of doubles by Arrow; the kept blocks are plain arrays.
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(float)
                label, weight = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                yield pa.RecordBatch.from_pydict({"x": [x.tobytes()], "label": [label.tobytes()], "weight": [weight.tobytes()]})

    def matrix(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, label, weight = (np.frombuffer(v) for v in block)
        return np.vstack([np.ones(len(label)), x.reshape(len(label), d).T]), label.astype(int), weight

    def all_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [matrix([c.as_py() for c in (b.column(i)[k] for i in range(3))]) for b in pack(batches) for k in range(b.num_rows)]
        if held:
            n, weights = sum(b[2].sum() for b in held), np.zeros((count, d + 1))
            for _ in range(epochs):
                add, total = _gradient(weights), np.zeros_like(weights)
                for block in held:  # a block's scores stay in the cache
                    total = add(total, block)
                weights = weights - rate * (total / n + weights * penalty)
            yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()]})

    try:
        rows = weighted.count()
        if rows * (d + 1) * count <= ONE_TASK:
            found = weighted.repartition(1).mapInArrow(all_steps, "weights binary").first()
            return np.frombuffer(found["weights"]).reshape(count, d + 1)
        tasks = part_count(rows, d, spark.sparkContext.defaultParallelism)
        blocks = weighted.repartition(tasks).mapInArrow(pack, "x binary, label binary, weight binary").rdd.map(matrix).persist(StorageLevel.MEMORY_AND_DISK)
        n = blocks.map(lambda b: b[2].sum()).sum()
        weights = np.zeros((count, d + 1))
        for _ in range(epochs):
            add, zero = _gradient(weights), np.zeros_like(weights)
            partial = blocks.mapPartitions(lambda held, add=add, zero=zero: [reduce(add, held, zero)]).collect()
            weights = weights - rate * (np.sum(partial, axis=0) / n + weights * penalty)
        blocks.unpersist()
        return weights
    finally:
        weighted.unpersist()


def part_count(rows: int, d: int, cores: int) -> int:
    """Parts of the kept blocks: no more than cores, unless a part would outgrow `PART_BYTES`."""
    return max(1, min(cores, -(-rows // BLOCK_ROWS)), -(-rows * (d + 3) * 8 // PART_BYTES))


def _gradient(weights: np.ndarray):
    def add(total: np.ndarray, block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        x, label, weight = block  # features x rows
        p = weights @ x
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p *= weight / p.sum(axis=0)
        p[label, np.arange(len(label))] -= weight
        return total + p @ x.T

    return add
