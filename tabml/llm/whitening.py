"""Whitening of embeddings by eigenvectors in mixed precision.

Entries become whole numbers, equal vectors count once, and their covariance is summed on Spark from rows centred before they
are multiplied. Eigenvectors start in float32 and are corrected by Ogita and Aishima's iteration, matrix products alone, in
extended precision (numpy's longdouble). Eigenvalues too close to be told apart are handled by a sub-solve: the covariance, shifted by
their mean, is projected on the cluster's vectors in extended precision, and the small matrix is solved in float64,
so that its own differences set the scale.

* A vector with a NULL, NaN or infinite entry is dropped, and so is a NULL vector. The dimension is the commonest length of the rest (the longer on a
  tie); rows of other lengths are dropped, and so are rows with an entry of `LARGEST` or more, whose whole numbers would not be exact.
* Equal vectors meet in a combined aggregate. Covariances are summed in each task (dimensions x dimensions numbers), then
  by matrix row on Spark; the driver gets one matrix. Contract: some thousand dimensions, for the matrix on the driver.
* Components whose eigenvalue is not above rounding are left out: they cannot be scaled to one. So equal vectors only, a
  single vector or an empty table have no components and no rows.
* `deviation` is computed in whole numbers; one beyond 64 bits is NULL.

Repeated rows are returned each. Input columns travel in a struct, so names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.sources.scratch import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
LARGEST = float(1 << 40)
ROWS = 4096  # of a matrix product at once


def whole_vectors(vector: Column) -> Column:
    """Entries as whole numbers; NULL for a vector with an entry that is NULL, not finite or too large."""
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return F.when(usable & vector.isNotNull(), F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _products(transform, dimensions: int, size: int):
    """Sums over a task's vectors of the outer products of `transform(vector)`, given out by row of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            for a in range(0, len(x), ROWS):
                z = transform(x[a : a + ROWS])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(size), size), pa.int32()), pa.array(np.tile(np.arange(size), size), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"]
        )

    return run


def _summed(vectors: DataFrame, transform, dimensions: int, size: int) -> np.ndarray:
    parts = vectors.select("x").mapInArrow(_products(transform, dimensions, size), "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((size, size))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return (out + out.T) / 2


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indices of eigenvalues that hang together by differences of at most `gap`, in order of size."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return np.split(order, cuts)


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration on the symmetric matrix `a` and approximate eigenvectors `x`: vectors, values, and the gap below which values can't be told apart."""
    n = len(a)
    r = np.eye(n, dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    gap = 2 * float(np.linalg.norm((s - np.diag(values)).astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
    apart = values[None, :] - values[:, None]
    cluster = np.zeros(n, int)
    for k, held in enumerate(clusters(values.astype(float), gap)):
        cluster[held] = k
    told = cluster[None, :] != cluster[:, None]
    e = np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
    np.fill_diagonal(e, np.diag(r) / 2)
    return x + x @ e, values, gap


def refined_eigen(a: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, to double precision."""
    n = len(a)
    scale = float(np.abs(a).max()) if n else 0.0
    if not scale:
        return np.zeros(n), np.eye(n)
    exact = (a / scale).astype(np.longdouble)
    x = np.linalg.eigh((a / scale).astype(np.float32))[1].astype(np.longdouble)
    close = 8 * n * np.finfo(np.longdouble).eps
    for _ in range(rounds):
        x, values, gap = corrected(exact, x)
        for held in clusters(values.astype(float), gap):
            if len(held) > 1:
                x[:, held] = _sub_solved(exact, x[:, held])
        x = _orthonormal(_orthonormal(x))
        r = np.eye(n, dtype=x.dtype) - x.T @ x
        s = x.T @ (exact @ x)
        off = np.abs(s - np.diag(np.diag(s))).max()
        if np.abs(r).max() < close and off < close:
            break
    values = (np.diag(s) / (1 - np.diag(r))).astype(float) * scale
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order].astype(float)


def _orthonormal(v: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns with what they miss squared."""
    return v + v @ (np.eye(v.shape[1], dtype=v.dtype) - v.T @ v) / 2


def _sub_solved(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The vectors of one cluster, turned so that they diagonalise the matrix on what they span."""
    v = _orthonormal(v)
    middle = ((v * (a @ v)).sum(axis=0) / (v * v).sum(axis=0)).mean()
    t = v.T @ (a @ v - middle * v)
    t = (t + t.T) / 2
    size = float(np.abs(t).max())
    if not size:
        return v
    turn = np.linalg.eigh((t / size).astype(float))[1].astype(v.dtype)
    return v @ _orthonormal(turn)


@dataclass
class Whitening:
    """`n` fitted vectors with the sums `total` per dimension; `values` and `vectors` of the components; shares of the trace; the largest
    difference between the covariance of the whitened fit list and the identity."""

    n: int
    total: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def dimensions(self) -> int:
        return len(self.total)

    def apply(self, x: np.ndarray) -> np.ndarray:
        return _whitened(x, self.total, self.n, self.vectors, self.values)


def _centred(x: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """x - total / n: the whole part of the mean is taken off in whole numbers, so that nothing cancels."""
    mean, rest = np.divmod(total, n)
    return (x - mean) - rest / n


def _whitened(x: np.ndarray, total: np.ndarray, n: int, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return _centred(x, total, n) @ vectors / np.sqrt(values)


def deviations(x: np.ndarray, total: np.ndarray, n: int) -> list[int | None]:
    """Sum over dimensions of (n x - total)**2, exact; None beyond 64 bits."""
    if not len(x):
        return []
    most = max(int(np.abs(x).max()) * n, int(np.abs(total).max()))
    if most < 1 << 62:
        away = x * n - total
        if int(np.abs(away).max()) ** 2 * x.shape[1] < 1 << 63:
            return (away * away).sum(axis=1).tolist()
    exact = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, total, strict=True)) for row in x]
    return [v if v < 1 << 63 else None for v in exact]


def fitted(vectors: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors `x` (whole numbers)."""
    distinct = stored(vectors.select("x").distinct(), "distinct-vectors")
    sums = distinct.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s"), F.count(F.lit(1)).alias("n")).toArrow()
    total, n = np.zeros(dimensions, np.int64), int(sums["n"][0].as_py())
    total[sums["pos"].to_numpy()] = sums["s"].to_numpy()
    covariance = _summed(distinct, lambda x: _centred(x, total, n), dimensions, dimensions) / n
    values, base = refined_eigen(covariance)
    trace = float(np.trace(covariance))
    kept = values[:components] > 4 * dimensions * np.finfo(float).eps * max(values[0], 0.0)
    values, base, size = values[:components][kept], np.ascontiguousarray(base[:, :components][:, kept]), int(kept.sum())
    if not size:
        return Whitening(n, total, values, base, values, 0.0)
    again = _summed(distinct, lambda x: _whitened(x, total, n, base, values), dimensions, size) / n
    return Whitening(n, total, values, base, values / trace, float(np.abs(again - np.eye(size)).max()))


def _applied(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        size = len(m.values)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _matrix(part.column(1), m.dimensions)
                n = len(x)
                row = pa.array(np.repeat(np.arange(n), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        pa.array(np.tile(np.arange(1, size + 1), n), pa.int32()),
                        pa.array(np.full(n * size, m.n)),
                        pa.array(deviations(x, m.total, m.n), pa.int64()).take(row),
                        pa.array(m.apply(x).ravel()),
                        pa.array(np.tile(m.explained, n)),
                        pa.array(np.full(n * size, m.identity_error)),
                    ],
                    ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, carry: Sequence[str] | None = None) -> DataFrame:
    """`(row, component, n, deviation, whitened, explained, identity_error)`: one row per usable row of `df` and component, from 1 by falling eigenvalue.

    `row` holds the input columns (those in `carry`).
    """
    spark = df.sparkSession
    carried = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row")
    rows = df.select(carried, whole_vectors(F.col(f"`{vector}`")).alias("x")).where(F.size("x") > 0)
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    names = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    fields = T.StructType([rows.schema["row"], *spark.createDataFrame([], names).schema])
    if sizes is None:
        return spark.createDataFrame([], fields)
    usable = rows.where(F.size("x") == sizes["d"])
    model = spark.sparkContext.broadcast(fitted(usable, sizes["d"], components))
    return usable.mapInArrow(_applied(model), fields)
