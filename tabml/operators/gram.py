"""Cross products of all features in one distributed aggregate."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame

# A Gram matrix has width^2 cells and lives on the driver: 2,000 features make 32 MB.
MAX_WIDTH = 2_000


def gram(df: DataFrame, columns: Column, size: int) -> np.ndarray:
    """Sum over all rows of x xT, where x is the given array column. Tree-aggregated in the JVM."""
    if size > MAX_WIDTH + 2:
        raise ValueError(f"{size} columns exceed the {MAX_WIDTH} this model can hold as a matrix.")
    rows = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(columns).alias("x")), "x")
    return RowMatrix(rows, numCols=size).computeGramianMatrix().toArray()
