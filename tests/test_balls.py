"""Search and clustering in balls: exact rounds, approximate probes, DBSCAN with a halo."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabml.operators import neighbors
from tabml.operators.learners import halo
from tabml.operators.learners.dbscan import dbscan
from tabml.operators.learners.halo import dbscan_halo
from tabml.operators.neighbors import nearest_neighbors
from tabml.plans import queries
from tests.test_learners import brute_neighbors, frame, sequential_dbscan

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("d,k,block", [(1, 3, 2048), (3, 7, 16), (8, 1, 64), (3, 400, 50)])
def test_rounds_are_exact(spark, d, k, block):
    rng = np.random.default_rng(d * k)
    t = np.concatenate([np.round(rng.normal(size=(300, d)), 1), rng.normal(4, 0.1, (80, d))])
    t[:100] = t[0]
    q = np.concatenate([np.round(rng.normal(size=(40, d)), 1), np.full((2, d), 50.0)])
    found = nearest_neighbors(frame(spark, q), frame(spark, t), k, "_row_id", "_row_id", small_bytes=0, block_rows=block, pivots=20)
    order, distance = brute_neighbors(q, t, k)
    rows = sorted((r["_row_id"], r["rank"], r["neighbor_id"], r["distance"]) for r in found.collect())
    assert [r[2] for r in rows] == list(order.ravel())
    assert [r[3] for r in rows] == pytest.approx(list(distance.ravel()))


def test_fewer_than_half_of_all_cells_are_searched(spark):
    x = np.random.default_rng(4).normal(size=(5000, 3))
    rows = frame(spark, x).selectExpr("_row_id as tid", "features as tf", "label")
    _, cells = neighbors._ball_tree(rows, 128)
    first = cells.nearest(x, 6, 1)
    order, distance = brute_neighbors(x[:500], x, 6)
    rest = cells.within(x[:500], distance[:, -1], first[:500])
    searched = sum(len(a) + len(b) for a, b in zip(first, rest))
    assert searched < 0.2 * 500 * len(cells.centers)
    cell_of = neighbors.distances(x, cells.centers).argmin(axis=1)
    assert all(set(cell_of[o]) <= set(a) | set(b) for o, a, b in zip(order, first, rest))


def test_approximate_neighbours_of_embeddings(spark):
    pick = lambda name: {(r["vec_id"], r["neighbor_id"]) for r in queries.QUERIES[name](spark, SF).collect()}
    exact, found = pick("knn_neighbors"), pick("knn_approx")
    assert len(found) == len(exact) and len(exact & found) >= 0.9 * len(exact)
    rows = queries.embedding_rows(spark, SF)
    few = nearest_neighbors(rows, rows, 5, "vec_id", "vec_id", exclude_self=True, probes=1)
    assert few.groupBy("vec_id").count().where("count <> 5").count() == 0  # cells are added until they hold k rows


@pytest.mark.parametrize("n,d,eps,min_pts,copies,balls,block", [(300, 2, 0.2, 4, 0, 10, 20), (260, 3, 0.5, 5, 90, 1, 2048), (200, 10, 2.2, 4, 30, 25, 7), (250, 1, 0.01, 3, 0, 8, 64)])
def test_halo_is_the_sequential_definition(spark, n, d, eps, min_pts, copies, balls, block):
    x = np.random.default_rng(n).normal(size=(n, d))
    x[:copies] = x[0] if copies else x[:0]
    label, core = sequential_dbscan(x, eps, min_pts)
    rows = frame(spark, x).withColumnRenamed("_row_id", "id")
    got = dbscan_halo(rows, eps, min_pts, d, small_edges=0 if d == 2 else None, balls=balls, block_rows=block).orderBy("id").collect()
    assert [r["prediction"] for r in got] == list(label)
    assert [r["is_core"] for r in got] == list(core)


def test_many_features_take_the_halo(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.1, (60, 20)), rng.normal(3, 0.1, (60, 20)), rng.normal(0, 9, (10, 20))])
    label, _ = sequential_dbscan(x, 1.0, 5)
    got = dbscan(frame(spark, x), 1.0, 5).orderBy("_row_id").collect()
    assert [r["prediction"] for r in got] == list(label) and set(label) == {-1, 0, 1}
    grid = dbscan(frame(spark, x[:, :4]), 0.5, 5, method="halo").orderBy("_row_id").collect()
    assert [r["prediction"] for r in grid] == list(sequential_dbscan(x[:, :4], 0.5, 5)[0])


@pytest.mark.parametrize("d,k,kind", [(1, 5, "ties"), (2, 6, "copies"), (2, 3, "far"), (3, 40, "ties"), (7, 2, "far"), (2, 90, "few"), (2, 5, "apart")])
def test_tree_of_boxes_is_exact_and_meets_few_rows(monkeypatch, d, k, kind):
    monkeypatch.setattr(neighbors, "MOST_PAIRS", 300)
    rng = np.random.default_rng(d * k)
    t = rng.normal(size=(50 if kind == "few" else 4000, d))
    if kind in ("ties", "copies"):
        t = np.round(t, 1)
    t[: {"copies": 1500}.get(kind, 0)] = 0.3
    q = np.concatenate([t[:200], rng.normal(size=(200, d)), np.full((3, d), 1e6 if kind == "far" else 9.0)])
    if kind == "apart":  # clusters, and one feature without any spread
        t[:, 1], t[::2, 0] = 1.0, t[::2, 0] + 1e9
    side = neighbors.SmallTrainingSet(Rows(t), k)
    order, distance = brute_neighbors(q, t, k)
    row, point, found = side.nearest(q, k)
    n = min(k, len(t))
    assert list(row) == list(np.repeat(np.arange(len(q)), n))
    assert list(side.ids[point]) == list(order[:, :n].ravel())
    assert list(found) == pytest.approx(list(distance[:, :n].ravel()))
    if d <= 2 and kind not in ("few", "copies"):
        assert sum(len(c[0]) for c in side.tree.candidates(t[1500:1700], k)) < 200 * 12 * k  # not 200 * 4000
    assert side.tree.least >= n or kind == "few"
    assert kind != "copies" or (side.points == 0.3).all(axis=1).sum() == k


def test_search_of_a_broadcast_side_does_not_grow_with_all_pairs():
    t = np.random.default_rng(5).normal(size=(200_000, 2))
    side = neighbors.SmallTrainingSet(Rows(t), 6)
    began = time.process_time()
    row, _, distance = side.nearest(t[:20_000], 6)
    assert len(row) == 120_000 and (distance[::6] == 0).all()
    assert time.process_time() - began < 10  # 4 billion pairs one by one take more than 30 s


def test_tree_of_boxes_meets_few_rows_beside_a_feature_of_few_values():
    rng = np.random.default_rng(6)
    t = np.stack([rng.normal(size=50_000), rng.integers(0, 25, 50_000) / 7], axis=1)
    side = neighbors.SmallTrainingSet(Rows(t), 6)
    assert sum(len(c[0]) for c in side.tree.candidates(t[:500], 6)) < 500 * 4 * 6  # thinly spread rows beside a line made it 52 a query
    order, distance = brute_neighbors(t[:500], t, 6)
    row, point, found = side.nearest(t[:500], 6)
    assert list(side.ids[point]) == list(order.ravel())
    assert list(found) == pytest.approx(list(distance.ravel()))


def test_queries_of_one_partition_are_searched_by_many_tasks(spark):
    rows = spark.range(0, 400, 1, 1).selectExpr("id AS qid", "array(double(id)) AS qf", "id AS tid", "array(double(id)) AS tf", "0.0D AS label")
    found = neighbors._by_broadcast(rows.select("qid", "qf"), rows.select("tid", "tf", "label"), 1)
    parts = found.select(F.spark_partition_id().alias("part"), "qid", "tid").toPandas()
    assert parts["part"].nunique() > 1  # as many as the input's, which was one
    assert sorted(parts["qid"]) == list(range(400)) and (parts["qid"] == parts["tid"]).all()


class Rows:
    """Training rows as `SmallTrainingSet` asks for them."""

    def __init__(self, x):
        self.x = x

    def toPandas(self):
        return pd.DataFrame({"tid": np.arange(len(self.x)), "tf": list(self.x), "label": 0.0})


def test_within_is_decided_as_by_distances(monkeypatch):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 3, (300, 20)) / 10, rng.integers(0, 3, (200, 20)) / 10
    exact = neighbors.distances(a, b)
    for most in (exact[0, 0], exact[5, 7], np.median(exact), 0.0):  # many pairs lie at the very distance
        assert (neighbors.within(a, b, most) == (exact <= most)).all()
    monkeypatch.setattr(neighbors, "distances", None)  # all pairs one feature at a time
    assert neighbors.within(a, a, 0.0).diagonal().all()


def test_a_query_travels_once_per_bucket():
    n = 1000
    cells = neighbors.Cells(np.zeros((n, 1)), np.full(n, 700.0), np.ones(n), np.zeros(n), np.arange(n) % 30, np.zeros((30, 1)), np.ones(30))
    buckets = neighbors.buckets_of(cells, neighbors.BUCKET_ROWS)
    assert len(np.unique(buckets)) <= 22  # a query was copied to each of the 1,000 cells
    assert np.bincount(buckets, cells.rows).max() <= neighbors.BUCKET_ROWS + 700


@pytest.mark.parametrize("kind", ["sphere", "ties", "far", "same", "huge", "few"])
def test_products_of_single_precision_give_the_same_neighbours(kind):
    rng = np.random.default_rng(11)
    t = {
        "sphere": lambda: rng.normal(size=(3000, 64)),
        "ties": lambda: rng.integers(0, 3, (3000, 12)) / 3,
        "far": lambda: np.concatenate([rng.normal(1e6, 1e-3, (1500, 10)), rng.normal(size=(1500, 10))]),  # slack of single precision is wide here
        "same": lambda: np.repeat(rng.normal(size=(5, 9)), 400, axis=0),
        "huge": lambda: rng.normal(size=(300, 8)) * 1e200,
        "few": lambda: rng.normal(size=(3, 20)),
    }[kind]()
    q, ids, k = np.concatenate([t[:1200], t[:50] * 1.01]), rng.permutation(len(t)), min(7, len(t))
    with np.errstate(over="ignore"):
        every = neighbors.distances(q, t)
        order = np.lexsort((np.broadcast_to(ids, every.shape), every), axis=1)[:, :k]
        row, point, found = neighbors._nearest_in_block(q, t, ids, k)
        assert (row == np.repeat(np.arange(len(q)), k)).all() and (point == order.ravel()).all()
        assert (found == np.take_along_axis(every, order, axis=1).ravel()).all()
    if kind != "huge":
        bound = np.take_along_axis(every, order, axis=1)[:, -1] * rng.choice([0.9, 1.0, 1.1], len(q))
        cell, near = np.sort(rng.integers(0, 9, len(t))), rng.random((len(q), 9)) < 0.6
        open_pairs = np.where(near[:, cell] & (every <= bound[:, None]), every, np.inf)
        order = np.lexsort((np.broadcast_to(ids, every.shape), open_pairs), axis=1)[:, :k]
        want = [(i, j) for i, o in enumerate(order) for j in o if np.isfinite(open_pairs[i, j])]
        row, point, _ = neighbors._nearest_in_tiles(q, t, ids, k, bound, cell, near)
        assert list(zip(row, point)) == want


def test_only_first_tiles_are_partitioned(monkeypatch):
    x = np.random.default_rng(12).normal(size=(20_000, 64))
    sizes, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *rest, **more: sizes.append(np.size(a)) or partition(a, *rest, **more))
    assert len(neighbors._nearest_in_block(x[:3000], x, np.arange(20_000), 6)[0]) == 18_000
    assert sum(sizes) <= 3000 * neighbors.TILE_POINTS  # all 60 million distances were ordered by partition, for some 25 ns a pair


def test_cells_that_may_hold_a_row_are_found_alike_by_products():
    rng = np.random.default_rng(13)
    x, centers = rng.normal(size=(500, 20)), rng.normal(size=(90, 20))
    away = neighbors.distances(x, centers)
    low, high = neighbors.by_products(x, centers)
    assert (low <= away).all() and (away <= high).all() and (high - low).max() < 1e-4
    upper = np.arange(90) % 9
    radius, inner = np.full(90, 3.0), np.full(90, 0.5)
    tops = centers[:9]
    reach = np.array([np.linalg.norm(centers[upper == i] - tops[i], axis=1).max() + 3 for i in range(9)])
    cells = neighbors.Cells(centers, np.ones(90), radius, inner, upper, tops, reach)
    bound, done = np.full(500, 2.0), [np.array([i % 90, (i * 7) % 90]) for i in range(500)]
    for i, found in enumerate(cells.within(x, bound, done)):
        assert set(found) == set(np.flatnonzero(np.maximum(away[i] - radius, inner - away[i]) <= 2 + 1e-6)) - set(done[i])


def test_rows_travel_only_where_their_block_leaves_something_open(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = np.concatenate([rng.normal(0, 0.2, (900, 20)), rng.normal(9, 0.2, (600, 20)), rng.normal(0, 40, (15, 20))])
    met, travelled = [], halo._travelled
    monkeypatch.setattr(halo, "_travelled", lambda asked, *rest: met.append(asked.agg(F.coalesce(F.sum(F.size("beside")), F.lit(0))).first()[0]) or travelled(asked, *rest))
    got = dbscan_halo(frame(spark, x).withColumnRenamed("_row_id", "id"), 1.6, 5, 20, balls=30, block_rows=150).orderBy("id").collect()
    label, core = sequential_dbscan(x, 1.6, 5)
    assert [r["prediction"] for r in got] == list(label) and [r["is_core"] for r in got] == list(core) and set(label) == {-1, 0, 1}
    assert max(met) < 250  # 15 rows to some blocks; each of the 1,515 rows went to every ball that may hold a row within eps


@pytest.mark.parametrize("kind", ["sphere", "clusters", "copies", "far", "flat"])
def test_blocks_of_dbscan_match_all_distances(monkeypatch, kind):
    monkeypatch.setattr(neighbors, "TILE_ROWS", 64)
    monkeypatch.setattr(neighbors, "TILE_POINTS", 64)
    rng = np.random.default_rng(15)
    x = {
        "sphere": lambda: rng.normal(size=(500, 30)),
        "clusters": lambda: rng.normal(size=(500, 12)) + 30 * rng.integers(0, 4, (500, 1)),
        "copies": lambda: rng.integers(0, 3, (500, 10)) / 10,
        "far": lambda: rng.normal(1e6, 1e-3, (500, 10)) * rng.choice([-1, 1], (500, 1)),
        "flat": lambda: rng.normal(size=(500, 2)),
    }[kind]()
    every = neighbors.distances(x, x)
    eps = every[3, 17] if kind == "copies" else np.quantile(every[every > 0], 0.004)  # many pairs lie at the very distance
    near, weight = every <= eps, rng.integers(1, 5, 500).astype(float)
    total = near[:200] @ weight
    found = halo.counted(x[:200], x, weight, eps, np.inf)
    assert (found == total).all()
    assert ((halo.counted(x[:200], x, weight, eps, 6) >= 6) == (total >= 6)).all()
    root = np.arange(500)
    for _ in range(500):
        root = np.where(near, root[None], 500).min(axis=1)
    assert (halo.united(x, x, np.arange(500), np.arange(500), 500, eps, same=True) == root).all()
    group = rng.integers(0, 9, 500)  # labels that rows share already
    want = group.copy()
    for _ in range(40):
        low = np.minimum(np.where(near[:200, 200:], want[None, 200:], 9).min(axis=1), want[:200])
        back = np.minimum(np.where(near[:200, 200:], low[:, None], 9).min(axis=0), want[200:])
        both = np.concatenate([low, back])
        least = np.full(9, 9)
        np.minimum.at(least, group, both)
        want = least[group]
    rooted = halo.united(x[:200], x[200:], group[:200], group[200:], 9, eps)
    assert (rooted[group] == want).all()
    assert (halo.lowest(x[:200], x, weight, eps) == np.where(near[:200], weight, np.inf).min(axis=1)).all()
