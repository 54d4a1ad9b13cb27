"""Exact nearest neighbours, by distance and then by id.

A small training side (checked against `SMALL_BYTES`) is sent to every task; with few features it is held as a tree of boxes
(`BoxTree`), so that a query meets a few leaves and not all rows. A larger one is cut
into cells: balls around pivot rows, which hang under fewer, larger balls. The search has two rounds. First each query
meets the cells nearest to it that hold k rows together, which gives the true distance of a k-th row as its bound. Then
the triangle inequality, for the large balls first and for the cells of those that remain, names the cells that may hold a closer row, and
only those are searched: neighbouring cells share a bucket, a query travels once to each bucket with such a cell and meets
these cells there. Cells, buckets and query groups of any size are cut into blocks of bounded size, so a hot
cell spreads over many tasks. Each block emits k rows per query at most, never all pairs.

`probes` makes the search approximate: each query meets its `probes` nearest cells and no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.values import col
from tabml.sources.scratch import checkpointed

SMALL_BYTES = 32 << 20
# Pivots grow with the square root of the training rows, within these limits.
MIN_PIVOTS, MAX_PIVOTS, PIVOT_BYTES = 128, 16384, 16 << 20
BLOCK_ROWS = 2048
# Rows of a side in a block of the second round at most: what is shuffled is the rows times the blocks of the other side.
BUCKET_ROWS = 32768
# Relative slack on bounds, far above rounding errors of a distance.
SLACK = 1e-9


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """All distances of two small blocks, summed feature by feature in order."""
    total = np.zeros((len(queries), len(points)))
    for j in range(queries.shape[1]):
        total += (queries[:, j, None] - points[None, :, j]) ** 2
    return np.sqrt(total)


# From so many features on, matrix products rule out most rows before exact distances are summed.
PRODUCT_FEATURES = 8


def _near_cells(queries: np.ndarray, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, point and exact distance of all pairs that may be among the k nearest of a row."""
    block = distances(queries, points)
    row, point = np.nonzero(block <= np.partition(block, k - 1, axis=1)[:, k - 1, None])
    return row, point, block[row, point]


def many_features(queries: np.ndarray, points: np.ndarray) -> bool:
    """Whether products can stand for distances: enough features, and no value whose square overflows."""
    return min(len(queries), len(points)) > 0 and points.shape[1] >= PRODUCT_FEATURES and all(x.max() < 1e100 and x.min() > -1e100 for x in (queries, points))


def by_products(queries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances of two small blocks; from `PRODUCT_FEATURES` on by one matrix product, else both are the distances."""
    if not many_features(queries, points):
        away = distances(queries, points)
        return away, away
    middle = points.mean(axis=0)
    a, b = queries - middle, points - middle
    size_a, size_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = size_a[:, None] + size_b[None] - 2 * (a @ b.T)
    slack = 64 * (queries.shape[1] + 4) * np.finfo(float).eps * (size_a + size_b.max())[:, None]
    return np.sqrt(np.maximum(0, rough - slack)), np.sqrt(np.maximum(0, rough + slack))


# Queries and points in a tile of products.
TILE_ROWS, TILE_POINTS = 1024, 1024


class Tiles:
    """Pairs of two blocks of many features that lie within a limit of each query, tile by tile.

    One product of single precision gives the square of a distance less the square of the limit and a slack far above its rounding errors; only where it isn't
    positive the exact distance is summed, in the order of `distances`, so that both give the same bits. A tile with many such pairs is first
    ruled out again in double precision, as the slack may be wide beside the limits.
    """

    def __init__(self, queries: np.ndarray, points: np.ndarray):
        middle = points.mean(axis=0)
        a, b = queries - middle, points - middle
        self.features = queries.shape[1]
        self.size_a, self.size_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
        self.by_feature = np.ascontiguousarray(queries.T), np.ascontiguousarray(points.T)
        self.double = max(self.size_a.max(), self.size_b.max()) > 1e30 or not 1e-30 < self.size_b.max()
        self.a, self.b = a, b
        self.sides = self._sides(np.float64 if self.double else np.float32)
        self.room = np.empty(TILE_ROWS * TILE_POINTS, self.sides[0].dtype)

    def _sides(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        one = np.ones((len(self.b), 1))
        left = np.concatenate([-2 * self.a, np.zeros((len(self.a), 1)), np.ones((len(self.a), 1))], axis=1)
        return left.astype(kind), np.concatenate([self.b, one, self.size_b[:, None]], axis=1).astype(kind)

    def rough(self, rows: np.ndarray, points: slice, square: np.ndarray | float, sides: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Squares of distances less `square` and the slack of each row."""
        left, right = sides or self.sides
        slack = 8 * (self.features + 4) * np.finfo(left.dtype).eps * (self.size_a[rows] + self.size_b.max() + square)
        part = left[rows]
        part[:, self.features] = self.size_a[rows] - square - slack
        other = right[points].T
        out = self.room[: len(rows) * other.shape[1]].reshape(len(rows), -1) if sides is None else None
        return np.matmul(part, other, out=out)

    def pairs(self, rows: np.ndarray, points: slice, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `rows` and points of the tile that may lie within the row's limit."""
        square = limit * limit
        row, point = _set(self.rough(rows, points, square) <= 0)
        if not self.double and len(row) > len(rows) * (points.stop - points.start) // 16:
            self.exact = getattr(self, "exact", None) or self._sides(np.float64)
            row, point = _set(self.rough(rows, points, square, self.exact) <= 0)
        return row, point + points.start

    def distances(self, row: np.ndarray, point: np.ndarray) -> np.ndarray:
        total = np.zeros(len(row))
        for x, y in zip(*self.by_feature):
            total += (x[row] - y[point]) ** 2
        return np.sqrt(total)


def _set(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that are set in a matrix where few are, looked for eight at a time."""
    flat = np.ascontiguousarray(mask).ravel()
    whole = len(flat) // 8 * 8
    eight = np.flatnonzero(flat[:whole].view(np.uint64))
    group, place = np.nonzero(flat[:whole].reshape(-1, 8)[eight])
    at = np.concatenate([eight[group] * 8 + place, whole + np.flatnonzero(flat[whole:])])
    return np.divmod(at, mask.shape[1])


def _nearest_in_tiles(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, bound: np.ndarray | None = None, cell: np.ndarray | None = None, near: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_nearest_in_block` for many features, of the points within `bound`, and of those whose `cell` (sorted) is `near` the query; limits shrink as points are met."""
    tiles, width = Tiles(queries, points), max(TILE_POINTS, k)
    tiles.room = np.empty(TILE_ROWS * width, tiles.room.dtype)
    limits = np.full(len(queries), np.inf) if bound is None else bound.astype(float)
    out = []
    for first in range(0, len(queries), TILE_ROWS):
        rows = np.arange(first, min(first + TILE_ROWS, len(queries)))
        limit, held, fresh = limits[rows].copy(), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
        for start in range(0, len(points), width):
            part = slice(start, min(start + width, len(points)))
            asking = np.arange(len(rows))
            if near is not None:
                asking = np.flatnonzero(near[rows, cell[start] : cell[part.stop - 1] + 1].any(axis=1))
                if not len(asking):
                    continue
            if bound is None and start == 0:
                rough = tiles.rough(rows, part, 0.0)
                slack = 8 * (tiles.features + 4) * np.finfo(rough.dtype).eps * (tiles.size_a[rows] + tiles.size_b.max())
                limit = np.sqrt(np.maximum(0, np.partition(rough, k - 1, axis=1)[:, k - 1].astype(float) + 3 * slack))
            row, point = tiles.pairs(rows[asking], part, limit[asking])
            row = asking[row]
            if near is not None:
                kept = near[rows[row], cell[point]]
                row, point = row[kept], point[kept]
            found = tiles.distances(rows[row], point)
            kept = found <= limit[row]
            held.append((row[kept], point[kept], found[kept]))
            fresh += int(kept.sum())
            if fresh > 2 * k * len(rows):
                held, fresh = [_first(*(np.concatenate(h) for h in zip(*held)), ids, k)], 0
                row, _, found = held[0]
                full = np.flatnonzero(np.bincount(row, minlength=len(rows)) == k)
                limit[full] = found[np.searchsorted(row, full, side="right") - 1]
        row, point, found = _first(*(np.concatenate(h) for h in zip(*held)), ids, k)
        out.append((row + first, point, found))
    return tuple(np.concatenate(p) for p in zip(*out))


def within(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Whether `distances(a, b) <= most`; from `PRODUCT_FEATURES` on only pairs too close to call by products are summed."""
    if a.shape[1] < PRODUCT_FEATURES or not len(a) or not len(b):
        return distances(a, b) <= most
    middle = b.mean(axis=0)
    x, y = a - middle, b - middle
    size_x, size_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    rough = size_x[:, None] + size_y[None] - 2 * (x @ y.T) - most * most
    slack = 64 * (a.shape[1] + 4) * np.finfo(float).eps * (size_x + size_y.max() + most * most)[:, None]
    near = rough <= 0
    row, point = np.nonzero(~(np.abs(rough) > slack))
    total = np.zeros(len(row))
    for j in range(a.shape[1]):  # in the order of `distances`
        total += (a[row, j] - b[point, j]) ** 2
    near[row, point] = np.sqrt(total) <= most
    return near


def _nearest_in_block(queries: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, position of the point and distance of the k nearest, ties by id."""
    k = min(k, len(points))
    if many_features(queries, points):
        return _nearest_in_tiles(queries, points, ids, k)
    step = max(1, (BLOCK_ROWS * BLOCK_ROWS) // max(1, len(points)))
    parts = []
    for start in range(0, len(queries), step):
        row, point, found = _first(*_near_cells(queries[start : start + step], points, k), ids, k)
        parts.append((row + start, point, found))
    return tuple(np.concatenate(p) for p in zip(*parts))


# Rows per leaf of a tree, pairs of a query and a node followed at once, distances computed at once.
LEAF_ROWS, MOST_PAIRS, MOST_DISTANCES = 32, 1 << 18, 1 << 20


class BoxTree:
    """Rows halved along their widest feature until a leaf holds a few, each node with the box of its rows.

    Rows of one value are halved along the next widest feature, so that a feature of few values doesn't leave thinly spread rows in
    a box of their own; a query finds its leaf by the same comparison. Boxes lie in levels, the children of node i are 2i and 2i + 1, and all leaves hold equally many rows, the last place of some
    a row at infinity. Distances to boxes are summed as those to rows are; rounding keeps order, so no row within a bound lies in a box beyond it.
    """

    def __init__(self, points: np.ndarray, least: int):
        leaf = max(LEAF_ROWS, 2 * least + 1)  # halves hold `least` rows still
        depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / leaf))))
        parts = [np.arange(len(points))]
        self.cuts: list[tuple[np.ndarray, np.ndarray]] = []
        for _ in range(depth):
            cut = [_halves(points, part) for part in parts]
            parts = [half for left, right, _, _ in cut for half in (left, right)]
            self.cuts.append((np.stack([axes for _, _, axes, _ in cut]), points[[row for *_, row in cut]]))
        size = max(len(p) for p in parts)
        self.least = min(len(p) for p in parts)
        self.rows = np.full((len(parts), size), -1)
        for i, part in enumerate(parts):
            self.rows[i, : len(part)] = part
        held = (self.rows >= 0)[:, :, None]
        placed = points[self.rows]
        low, high = np.where(held, placed, np.inf).min(axis=1), np.where(held, placed, -np.inf).max(axis=1)
        self.points = np.where(held, placed, np.inf)
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.levels.insert(0, (low, high))

    def _away(self, queries: np.ndarray, level: int, node: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        total = np.zeros(len(node))
        for j in range(queries.shape[1]):
            total += np.maximum(0, np.maximum(low[node, j] - queries[:, j], queries[:, j] - high[node, j])) ** 2
        return np.sqrt(total)

    def _bounds(self, queries: np.ndarray, k: int) -> np.ndarray:
        """Distance of the k-th row in the leaf that a query falls into."""
        node = np.zeros(len(queries), np.int64)
        for axes, cut in self.cuts:
            less, same = np.zeros(len(queries), bool), np.ones(len(queries), bool)
            for j in range(queries.shape[1]):
                axis = axes[node, j]
                own, other = queries[np.arange(len(queries)), axis], cut[node, axis]
                less |= same & (own < other)
                same &= own == other
            node = 2 * node + ~less
        return np.partition(self._distances(queries, np.arange(len(queries)), node), k - 1, axis=1)[:, k - 1]

    def _distances(self, queries: np.ndarray, row: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        total = np.zeros((len(row), self.points.shape[1]))
        for j in range(queries.shape[1]):
            total += (queries[row, j, None] - self.points[leaf, :, j]) ** 2
        return np.sqrt(total)

    def candidates(self, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row of the query, point and distance of all points that may be among the k nearest; all points of a query come together."""
        step = max(1, MOST_DISTANCES // self.points.shape[1])
        parts = [np.arange(at, min(at + step, len(queries))) for at in range(0, len(queries), step)][::-1]
        bounds = np.concatenate([self._bounds(queries[p], k) for p in parts[::-1]])
        while parts:
            asked = parts.pop()
            row, node = asked, np.zeros(len(asked), np.int64)
            for level in range(1, len(self.levels)):
                row, node = np.repeat(row, 2), np.repeat(2 * node, 2)
                node[1::2] += 1
                near = self._away(queries[row], level, node) <= bounds[row]
                row, node = row[near], node[near]
                if len(row) > MOST_PAIRS and len(asked) > 1:
                    break
            if len(row) > MOST_PAIRS and len(asked) > 1:  # many boxes are near: fewer queries at once
                parts += [asked[len(asked) // 2 :], asked[: len(asked) // 2]]
                continue
            found = []
            for at in range(0, len(row), step):
                r, leaf = row[at : at + step], node[at : at + step]
                away = self._distances(queries, r, leaf)
                pair, place = np.nonzero(away <= bounds[r, None])
                found.append((r[pair], self.rows[leaf[pair], place], away[pair, place]))
            yield tuple(np.concatenate(f) for f in zip(*found))


def _halves(points: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Both halves, the features from the widest on, and the first row of the second half in their order."""
    axes = np.argsort(-np.ptp(points[part], axis=0), kind="stable")
    left, right, undecided, middle = [], [], part, len(part) // 2
    for axis in axes:
        value = points[undecided, axis]
        cut = np.partition(value, middle)[middle]
        below = value < cut
        left.append(undecided[below])
        right.append(undecided[value > cut])
        undecided, middle = undecided[value == cut], middle - int(below.sum())
        if len(undecided) == 1:
            break
    return np.concatenate([*left, undecided[:middle]]), np.concatenate([*right, undecided[middle:]]), axes, undecided[middle]


def _first(row: np.ndarray, point: np.ndarray, found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest of each query's candidates, ties by id."""
    order = np.lexsort((ids[point], found, row))
    row, point, found = row[order], point[order], found[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[keep], point[keep], found[keep]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, 0))


def nearest_neighbors(
    queries: DataFrame, train: DataFrame, k: int, query_id: str, train_id: str, label: str | None = None,
    features: str = "features", exclude_self: bool = False, small_bytes: int | None = None, pivots: int | None = None, block_rows: int = BLOCK_ROWS, probes: int | None = None,
) -> DataFrame:
    """`(query_id, rank, train_id, distance, label)`: the k nearest training rows of each query.

    Ids must be unique and integer. `label` is an optional numeric column handed through. With
    `exclude_self` a training row of the same id is not its own neighbour. With `probes` the
    result is approximate: rows of that many cells nearest to the query only, or of more until they hold k rows.
    """
    label_column = col(label).cast("double") if label else F.lit(None).cast("double")
    q = queries.select(col(query_id).cast("bigint").alias("qid"), col(features).alias("qf"))
    t = train.select(col(train_id).cast("bigint").alias("tid"), col(features).alias("tf"), label_column.alias("label"))
    # One extra candidate makes up for the row itself.
    wanted = k + 1 if exclude_self else k
    limit = SMALL_BYTES if small_bytes is None else small_bytes
    size = t.agg(F.count(F.lit(1)), F.max(F.size("tf"))).first()
    if size[0] == 0:
        raise ValueError("No training rows are available.")
    if probes is None and size[0] * (size[1] + 2) * 8 <= limit:
        found = _by_broadcast(q, t, wanted)
    else:
        most = max(MIN_PIVOTS, min(MAX_PIVOTS, PIVOT_BYTES // (8 * max(1, size[1]))))
        count = pivots or int(min(most, max(MIN_PIVOTS, size[0] ** 0.5)))
        found = _by_cells(q, t, wanted, count, block_rows, probes)
    if exclude_self:
        found = found.where(F.col("qid") != F.col("tid"))
    window = Window.partitionBy("qid").orderBy("distance", "tid")
    ranked = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    columns = [F.col("qid").alias(query_id), "rank", F.col("tid").alias("neighbor_id"), "distance"]
    return ranked.select(*columns, *([F.col("label").alias("neighbor_label")] if label else []))


_FOUND = "qid bigint, tid bigint, distance double, label double"


def _found(qid, row, tid, point, distance, label) -> pd.DataFrame:
    return pd.DataFrame({"qid": qid[row], "tid": tid[point], "distance": distance, "label": label[point]})


def rows_of(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of equal length as a matrix, without an object per row."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _found_table(qid, row, tid, point, distance, label) -> pa.Table:
    return pa.table({"qid": qid[row].astype(np.int64), "tid": tid[point].astype(np.int64), "distance": distance.astype(float), "label": pa.array(label[point].astype(float), from_pandas=True)})


class SmallTrainingSet:
    """A training side of checked size held as arrays, for searches of up to `k` rows; a tree where there are few features."""

    def __init__(self, train: DataFrame, k: int):
        rows = train.toPandas().sort_values("tid")
        points, ids, labels = _matrix(rows["tf"]), rows["tid"].to_numpy(), rows["label"].to_numpy(dtype=float)
        # Of equal vectors only the k smallest ids can be among k neighbours.
        kept = np.sort(_first_copies(points, k))
        self.points, self.ids, self.labels = points[kept], ids[kept], labels[kept]
        few = 0 < self.points.shape[1] < PRODUCT_FEATURES and np.isfinite(self.points).all()
        self.tree = BoxTree(self.points, k) if few else None

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of the query, position of the point and distance of the k nearest, ties by id."""
        k = min(k, len(self.points))
        if self.tree is None or k > self.tree.least or not len(queries) or not np.isfinite(queries).all():
            return _nearest_in_block(queries, self.points, self.ids, k)
        parts = [_first(*found, self.ids, k) for found in self.tree.candidates(queries, k)]
        return tuple(np.concatenate(p) for p in zip(*parts))


def _first_copies(points: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k copies of each vector."""
    order = np.lexsort(points.T[::-1]) if points.shape[1] else np.arange(len(points))  # keeps the order of copies
    fresh = np.append(True, (points[order][1:] != points[order][:-1]).any(axis=1))[: len(order)]
    start = np.flatnonzero(fresh)
    return order[np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order)))) < k]


def _by_broadcast(q: DataFrame, t: DataFrame, k: int) -> DataFrame:
    held = q.sparkSession.sparkContext.broadcast(SmallTrainingSet(t, k))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        side = held.value
        for batch in batches:
            if len(batch):
                found = side.nearest(_matrix(batch["qf"]), k)
                yield _found(batch["qid"].to_numpy(), found[0], side.ids, found[1], found[2], side.labels)

    return _dealt(q).mapInPandas(search, _FOUND)


def _dealt(q: DataFrame) -> DataFrame:
    """Queries over all cores: a small file or a micro-batch comes as one partition, however many rows it holds."""
    spark = q.sparkSession
    return q.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "qid")


@dataclass
class Cells:
    """Balls of training rows in two levels, small enough for every task.

    `centers`, `radius` and `inner` (largest and smallest distance of a row) per cell with `rows` in it; `upper`: large ball of each
    cell; `tops`, `reach`: centers of the large balls and the largest distance of a row in any of their cells.
    """

    centers: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    inner: np.ndarray
    upper: np.ndarray
    tops: np.ndarray
    reach: np.ndarray

    def nearest(self, features: np.ndarray, k: int, probes: int) -> list[np.ndarray]:
        """Per query the nearest cells: `probes` of them, or more until they hold k rows."""
        out = []
        for start in range(0, len(features), BLOCK_ROWS):
            away = by_products(features[start : start + BLOCK_ROWS], self.centers)[0]
            few = min(len(self.centers), max(8, 2 * probes))
            while True:  # mostly the nearest few hold k rows
                order = np.argpartition(away, few - 1, axis=1)[:, :few] if few < len(self.centers) else np.tile(np.arange(few), (len(away), 1))
                order = np.take_along_axis(order, np.argsort(np.take_along_axis(away, order, axis=1), axis=1, kind="stable"), axis=1)
                held = np.cumsum(self.rows[order], axis=1)
                if few == len(self.centers) or (held[:, -1] >= k).all():
                    break
                few = min(len(self.centers), 4 * few)
            need = np.minimum(np.maximum((held < k).sum(axis=1) + 1, probes), few)
            out += [np.sort(o[:n]) for o, n in zip(order, need)]
        return out

    def within(self, features: np.ndarray, bound: np.ndarray, done: list[np.ndarray]) -> list[np.ndarray]:
        """Per query the cells not done yet that may hold a row within the bound."""
        limit = bound * (1 + SLACK) + SLACK
        out: list[np.ndarray] = []
        for start in range(0, len(features), BLOCK_ROWS):
            rows = slice(start, start + BLOCK_ROWS)
            open_tops = by_products(features[rows], self.tops)[0] - self.reach[None] <= limit[rows, None]
            near = np.zeros((len(open_tops), len(self.centers)), bool)
            for top in np.flatnonzero(open_tops.any(axis=0)):
                cells, asked = np.flatnonzero(self.upper == top), np.flatnonzero(open_tops[:, top])
                near[np.ix_(asked, cells)] = self.may_hold(features[rows][asked], cells, limit[rows][asked])
            done_here = done[rows]
            near[np.repeat(np.arange(len(near)), [len(d) for d in done_here]), np.concatenate([*done_here, np.zeros(0, np.int64)]).astype(np.int64)] = False
            row, cell = np.nonzero(near)
            out += np.split(cell, np.searchsorted(row, np.arange(1, len(near))))
        return out

    def may_hold(self, features: np.ndarray, cells: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Whether each of the cells may hold a row within the query's limit, by the triangle inequality."""
        low, high = by_products(features, self.centers[cells])
        return np.maximum(low - self.radius[cells], self.inner[cells] - high) <= limit[:, None]


def _ball_tree(t: DataFrame, pivots: int) -> tuple[DataFrame, Cells]:
    """Training rows with their `cell`, and the cells."""
    # `pivots` rows, whatever the size of the data.
    centers = np.unique(_matrix(_drawn(t, pivots)["tf"]), axis=0)
    roots = centers[np.random.default_rng(1).permutation(len(centers))[: max(1, int(len(centers) ** 0.5))]]
    under = distances(centers, roots).argmin(axis=1)

    @F.pandas_udf("struct<cell:int, away:double, up:double>")
    def place(features: pd.Series) -> pd.DataFrame:
        rows = _matrix(features)
        cell, away, up = np.zeros(len(rows), np.int32), np.zeros(len(rows)), np.zeros(len(rows))
        for start in range(0, len(rows), BLOCK_ROWS):
            part = slice(start, start + BLOCK_ROWS)
            cell[part] = by_products(rows[part], centers)[0].argmin(axis=1)
            away[part] = np.sqrt(((rows[part] - centers[cell[part]]) ** 2).sum(axis=1))
            up[part] = np.sqrt(((rows[part] - roots[under[cell[part]]]) ** 2).sum(axis=1))
        return pd.DataFrame({"cell": cell, "away": away, "up": up})

    placed = checkpointed(t.withColumn("p", place("tf")).select("tid", "tf", "label", "p.cell", "p.away", "p.up"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r"), F.min("away").alias("i"), F.max("up").alias("u")).toPandas()
    rows, radius, inner, reach = np.zeros(len(centers)), np.zeros(len(centers)), np.zeros(len(centers)), np.zeros(len(roots))
    at = sizes["cell"].to_numpy()
    rows[at], radius[at], inner[at] = sizes["n"], sizes["r"], sizes["i"]
    np.maximum.at(reach, under[at], sizes["u"].to_numpy())
    # cells are pivots of the training side, and so each holds a row
    return placed.drop("away", "up"), Cells(centers, rows, radius, inner, under, roots, reach * (1 + SLACK))


def _drawn(t: DataFrame, n: int) -> pd.DataFrame:
    """The `n` rows of least hash; only about that many leave the tasks."""
    total = t.count()
    digest = F.xxhash64("tid")
    if total > 4 * n:
        edge = int(-(1 << 63) + (1 << 64) * (2 * n / total))
        few = t.where(digest <= edge)
        t = few if few.count() >= n else t
    return t.select("tf").orderBy(digest, "tid").limit(n).toPandas()


def _by_cells(q: DataFrame, t: DataFrame, k: int, pivots: int, block_rows: int, probes: int | None = None) -> DataFrame:
    # Of equal vectors only the k smallest ids can be among k neighbours: copies collapse here, in
    # each task first.
    copies = Window.partitionBy("tf").orderBy("tid")
    t = t.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k).drop("_copy")
    placed, cells = _ball_tree(t, pivots)
    held = q.sparkSession.sparkContext.broadcast(cells)

    @F.pandas_udf("array<int>")
    def home(features: pd.Series) -> pd.Series:
        return pd.Series(held.value.nearest(_matrix(features), k, probes or 1)) if len(features) else pd.Series([], dtype=object)

    asked = q.withColumn("done", home("qf"))
    if probes is not None:
        return _searched(asked.select("qid", "qf", F.explode("done").alias("cell")), placed, k, block_rows)
    asked = checkpointed(asked)
    first = checkpointed(_searched(asked.select("qid", "qf", F.explode("done").alias("cell")), placed, k, block_rows))
    ranked = Window.partitionBy("qid").orderBy("distance")
    place = first.select("qid", "distance", F.row_number().over(ranked).alias("place"))
    bounds = place.where(F.col("place") <= k).groupBy("qid").agg(F.max(F.struct("place", "distance")).alias("b"))
    # fewer than k rows in all: the first round met them
    bounds = bounds.select("qid", F.when(F.col("b.place") == k, F.col("b.distance")).otherwise(F.lit(-1.0)).alias("bound"))
    rest = asked.join(bounds, "qid").where("bound >= 0").select("qid", "qf", "bound", "done")
    return first.unionByName(_rest(rest, placed, cells, held, k, max(block_rows, min(BUCKET_ROWS, int(cells.rows.sum()) // 8))))


def buckets_of(cells: Cells, most: int) -> np.ndarray:
    """Bucket of each cell: cells of a large ball next to each other, about `most` rows together."""
    order = np.argsort(cells.upper, kind="stable")
    out = np.zeros(len(order), np.int32)
    out[order] = (np.cumsum(cells.rows[order]) - cells.rows[order]) // most
    return out


def _rest(rest: DataFrame, placed: DataFrame, cells: Cells, held, k: int, block_rows: int) -> DataFrame:
    """The k nearest rows within each query's `bound`, in the cells not `done`; a query travels once per bucket."""
    bucket_of = buckets_of(cells, block_rows)
    buckets = int(bucket_of.max()) + 1

    @F.pandas_udf("array<int>")
    def others(features: pd.Series, bound: pd.Series, done: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=object)
        near = held.value.within(_matrix(features), bound.to_numpy(dtype=float), list(done))
        row = np.repeat(np.arange(len(near)), [len(c) for c in near])
        row, bucket = np.divmod(np.unique(row * buckets + bucket_of[np.concatenate([*near, np.zeros(0, np.int64)])]), buckets)
        return pd.Series(np.split(bucket, np.searchsorted(row, np.arange(1, len(near)))))

    # the queries are written once, not once per bucket
    rest = checkpointed(rest.withColumn("buckets", others("qf", "bound", "done")))
    names = placed.sparkSession.createDataFrame(pd.DataFrame({"cell": np.arange(len(bucket_of), dtype=np.int32), "bucket": bucket_of}), "cell int, bucket int")
    placed = placed.join(F.broadcast(names), "cell")
    demand = rest.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n_q"))
    supply = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_t"))
    # one row per bucket
    cuts = F.broadcast(demand.join(supply, "bucket").select("bucket", *[F.ceil(F.col(f"n_{c}") / block_rows).cast("int").alias(f"{c}_n") for c in "qt"]))

    def split(df: DataFrame, id_column: str, own: str, other: str) -> DataFrame:
        met = df.join(cuts, "bucket").withColumn(f"{own}b", F.pmod(F.xxhash64(id_column), F.col(f"{own}_n")).cast("int"))
        return met.withColumn(f"{other}b", F.explode(F.sequence(F.lit(0), F.col(f"{other}_n") - 1))).drop("q_n", "t_n")

    def search(key, lq: pa.Table, rt: pa.Table) -> pa.Table:
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        qid, tid, cell, label = lq["qid"].to_numpy(), rt["tid"].to_numpy(), rt["cell"].to_numpy(), rt["label"].to_numpy()
        order = np.argsort(cell, kind="stable")
        tid, cell, label = tid[order], cell[order], label[order]
        if len(lq) and len(rt):
            x, t = rows_of(lq["qf"]), rows_of(rt["tf"])[order]
            bound, c = lq["bound"].to_numpy(), held.value
            here, place = np.unique(cell, return_inverse=True)
            many = many_features(x, t)
            limit = bound * (1 + SLACK) + SLACK
            near = c.may_hold(x, here, limit) if many else np.stack([np.maximum(away - c.radius[i], c.inner[i] - away) <= limit for i in here for away in distances(x, c.centers[i : i + 1]).T], axis=1)
            cells_done = lq["done"].combine_chunks()
            met, done = np.repeat(np.arange(len(lq)), cells_done.value_lengths().to_numpy()), cells_done.flatten().to_numpy()
            at = np.minimum(np.searchsorted(here, done), len(here) - 1)
            same = here[at] == done
            near[met[same], at[same]] = False
            asking = np.flatnonzero(near.any(axis=1))
            if many and len(asking):
                row, point, found = _nearest_in_tiles(x[asking], t, tid, k, bound[asking], place, near[asking])
                parts.append((asking[row], point, found))
            for i in [] if many else range(len(here)):
                asking, rows = np.flatnonzero(near[:, i]), np.flatnonzero(place == i)
                if len(asking):
                    row, point, found = _nearest_in_block(x[asking], t[rows], tid[rows], k)
                    kept = found <= bound[asking[row]]
                    parts.append((asking[row[kept]], rows[point[kept]], found[kept]))
        row, point, found = (np.concatenate(p) for p in zip(*parts))
        row, point, found = _first(row, point, found, tid, k)
        return _found_table(qid, row, tid, point, found, label)

    left = split(rest.select("qid", "qf", "bound", "done", F.explode("buckets").alias("bucket")), "qid", "q", "t")
    keys = ["bucket", "qb", "tb"]
    return left.groupBy(*keys).cogroup(split(placed, "tid", "t", "q").groupBy(*keys)).applyInArrow(search, _FOUND)


def _searched(asked: DataFrame, placed: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The k nearest rows of each asked cell."""
    asked = checkpointed(asked)
    demand = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n_q"))
    supply = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_t"))
    # one row per cell
    cuts = demand.join(supply, "cell").select("cell", *[F.ceil(F.col(f"n_{c}") / block_rows).cast("int").alias(f"{c}_n") for c in "qt"])

    def split(df: DataFrame, id_column: str, own: str, other: str) -> DataFrame:
        met = df.join(F.broadcast(cuts), "cell").withColumn(f"{own}b", F.pmod(F.xxhash64(id_column), F.col(f"{own}_n")).cast("int"))
        return met.withColumn(f"{other}b", F.explode(F.sequence(F.lit(0), F.col(f"{other}_n") - 1))).drop("q_n", "t_n")

    left, right = split(asked, "qid", "q", "t"), split(placed, "tid", "t", "q")

    def search(key, lq: pa.Table, rt: pa.Table) -> pa.Table:
        row, point, distance = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        tid = rt["tid"].to_numpy()
        if len(lq) and len(rt):
            row, point, distance = _nearest_in_block(rows_of(lq["qf"]), rows_of(rt["tf"]), tid, k)
        return _found_table(lq["qid"].to_numpy(), row, tid, point, distance, rt["label"].to_numpy())

    keys = ["cell", "qb", "tb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _FOUND)
