import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.operators import evaluate as ev
from tabml.operators import explain as ex
from tabml.operators.learners.bayes import train_bayes
from tabml.operators.learners.dbscan import dbscan, estimate_eps, train_dbscan
from tabml.operators.learners.kmeans import train_kmeans
from tabml.operators.learners.linear import train_linear
from tabml.operators.learners.softmax import train_softmax
from tabml.operators.neighbors import nearest_neighbors
from tabml.operators.projection import fit_pca
from tabml.operators.training import train


def frame(spark, x, y=None):
    labels = np.zeros(len(x)) if y is None else y
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "_row_id bigint, features array<double>, label double").repartition(5).cache()


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 4))
    y = (x[:, 0] + 0.3 * rng.normal(size=240) > 0).astype(int) + (x[:, 1] > 0.8)
    return x, y, frame(spark, x, y)


def by_id(df, column):
    return [r[column] for r in df.orderBy("_row_id").collect()]


def test_linear_matches_row_wise_descent(spark, data):
    x, _, _ = data
    y = 3 * x[:, 0] - x[:, 2] + 10
    model = train_linear(frame(spark, x, y))
    t, full, w = (y - y.mean()) / y.std(), np.column_stack([np.ones(len(x)), x]), np.zeros(5)
    for _ in range(900):
        penalty = 0.001 * w
        penalty[0] = 0
        w = w - 0.04 * (full.T @ (full @ w - t) / len(x) + penalty)
    assert model.weights == pytest.approx(list(w), abs=1e-10)
    exact = train_linear(frame(spark, x, y), solver="ridge")
    a = full.T @ full / len(x) + np.diag([0] + [0.001] * 4)
    assert exact.weights == pytest.approx(list(np.linalg.solve(a, full.T @ t / len(x))), abs=1e-8)
    assert by_id(model.transform(frame(spark, x, y)), "prediction") == pytest.approx(list(full @ w * y.std() + y.mean()))


def softmax(s):
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_softmax(spark, data):
    x, y, df = data
    full, w = np.column_stack([np.ones(len(x)), x]), np.zeros((3, 5))
    penalty = np.array([0, *[0.001] * 4])
    for _ in range(6):
        w = w - 0.08 * ((softmax(full @ w.T) - np.eye(3)[y]).T @ full / len(x) + w * penalty)
    model = train_softmax(df, solver="gd", epochs=6)
    assert model.weights == pytest.approx(w, abs=1e-12)
    p = np.array(by_id(model.transform(df), "probability"))
    assert p == pytest.approx(softmax(full @ w.T))
    w = train_softmax(df, solver="converged").weights
    gradient = (softmax(full @ w.T) - np.eye(3)[y]).T @ full / len(x) + w * penalty
    assert np.abs(gradient).max() < 1e-4


def test_bayes_with_an_unseen_class(spark, data):
    x, y, df = data
    model = train_bayes(df, classes=4)
    assert model.priors[3] == 1e-6 and (model.variances[3] == 1e-4).all()
    for c in range(3):
        assert model.means[c] == pytest.approx(x[y == c].mean(axis=0))
        assert model.variances[c] == pytest.approx(np.maximum(x[y == c].var(axis=0), 1e-4))
    score = np.array([[np.log(model.priors[c]) + np.sum(-0.5 * np.log(2 * np.pi * model.variances[c]) - (r - model.means[c]) ** 2 / (2 * model.variances[c])) for c in range(4)] for r in x])
    scored = model.transform(df)
    assert np.array(by_id(scored, "probability")) == pytest.approx(softmax(score))
    assert by_id(scored, "prediction") == list(score.argmax(axis=1))


def brute_neighbors(q, t, k):
    d = np.sqrt(((q[:, None, :] - t[None]) ** 2).sum(axis=2))
    order = np.lexsort((np.broadcast_to(np.arange(len(t)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, axis=1)


@pytest.mark.parametrize("small_bytes", [None, 0])
def test_neighbors(spark, small_bytes):
    rng = np.random.default_rng(5)
    t = np.round(rng.normal(size=(700, 3)), 1)
    t[:230] = t[0]  # a third of the rows are copies
    q = np.round(rng.normal(size=(90, 3)), 1)
    found = nearest_neighbors(frame(spark, q), frame(spark, t), 6, "_row_id", "_row_id", small_bytes=small_bytes, block_rows=64, pivots=12)
    order, distance = brute_neighbors(q, t, 6)
    rows = sorted((r["_row_id"], r["rank"], r["neighbor_id"], r["distance"]) for r in found.collect())
    assert [r[2] for r in rows] == list(order.ravel())
    assert [r[3] for r in rows] == pytest.approx(list(distance.ravel()))
    alone = nearest_neighbors(frame(spark, t[:3]), frame(spark, t[:3]), 5, "_row_id", "_row_id", exclude_self=True, small_bytes=small_bytes)
    assert alone.count() == 6


@pytest.mark.parametrize("small_bytes", [None, 0])
def test_knn_models(spark, data, small_bytes):
    x, y, df = data
    new = np.random.default_rng(8).normal(size=(40, 4))
    order, d = brute_neighbors(new, x, 7)
    w = 1 / (d + 1e-6)
    votes = np.stack([(w * (y[order] == c)).sum(axis=1) for c in range(3)], axis=1)
    model = train("classification", "knnClassifier", df, classes=3, small_bytes=small_bytes)
    assert model.k == 7
    scored = model.transform(frame(spark, new))
    assert np.array(by_id(scored, "probability")) == pytest.approx(votes / votes.sum(axis=1, keepdims=True))
    assert by_id(scored, "prediction") == list(votes.argmax(axis=1))
    values = train("regression", "knnRegressor", df, small_bytes=small_bytes).transform(frame(spark, new))
    assert by_id(values, "prediction") == pytest.approx(list((w * y[order]).sum(axis=1) / w.sum(axis=1)))


@pytest.mark.parametrize("method", ["node", "bins"])
def test_tree_methods(spark, data, method):
    x, y, df = data
    tree = train("classification", "treeClassifier", df, classes=3, method=method)
    forest = train("classification", "forestClassifier", df, classes=3, method=method)
    for model in (tree, forest):
        p = np.array(by_id(model.transform(df), "probability"))
        assert p.sum(axis=1) == pytest.approx(np.ones(len(p)))
        assert np.mean(p.argmax(axis=1) == y) > 0.85
    votes = np.array(by_id(forest.transform(df), "probability")) * 17
    assert votes == pytest.approx(np.round(votes))
    values = train("regression", "forestRegressor", df, method=method)
    assert np.mean((np.array(by_id(values.transform(df), "prediction")) - y) ** 2) < 0.2


def plain_tree(x, t, classes, depth=0):
    """The definition, row by row: returns a function from a row to (class shares or mean)."""
    def impurity(v):
        return 1 - sum((np.mean(v == c)) ** 2 for c in range(classes)) if classes else np.var(v)

    def leaf():
        value = np.array([np.mean(t == c) for c in range(classes)]) if classes else t.mean()
        return lambda row: value

    here, best = impurity(t), (1e-9, None, None)
    if depth >= 6 or len(t) <= 4 or here <= 1e-9:
        return leaf()
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        step = max(1, len(values) // 12)
        for i in range(step, len(values), step):
            cut = (values[i - 1] + values[i]) / 2
            low = x[:, j] <= cut
            if low.sum() < 4 or (~low).sum() < 4:
                continue
            gain = here - low.mean() * impurity(t[low]) - (~low).mean() * impurity(t[~low])
            if gain > best[0] + 1e-12:
                best = (gain, j, cut)
    if best[1] is None:
        return leaf()
    low = x[:, best[1]] <= best[2]
    left, right = (plain_tree(x[m], t[m], classes, depth + 1) for m in (low, ~low))
    return lambda row: (left if row[best[1]] <= best[2] else right)(row)


@pytest.mark.parametrize("small_rows", [None, 20])
def test_tree_splits(spark, data, monkeypatch, small_rows):
    from tabml.operators import ordering

    if small_rows:
        monkeypatch.setattr(ordering, "SMALL_ROWS", small_rows)
    x, y, df = data
    want = plain_tree(x, y, 3)
    model = train("classification", "treeClassifier", df, classes=3)
    assert np.array(by_id(model.transform(df), "probability")) == pytest.approx(np.array([want(r) for r in x]))
    numbers = 100 + 3 * x[:, 2] + x[:, 0]
    value = plain_tree(x, numbers, None)
    model = train("regression", "treeRegressor", frame(spark, x, numbers))
    assert by_id(model.transform(df), "prediction") == pytest.approx([value(r) for r in x])
    assert np.argmax(model.importances) == 2


def test_forest_does_not_depend_on_partitions(spark, data):
    _, _, df = data
    a, b = (train("classification", "forestClassifier", d, classes=3, method="node").transform(df) for d in (df, df.repartition(2)))
    assert by_id(a, "probability") == by_id(b, "probability")


def test_lloyd(spark, data):
    x, _, df = data
    start = x[[0, 1, 2]]
    previous = np.inf
    for rounds in (1, 2, 5):
        inertia = train_kmeans(df, init_centers=start, rounds=rounds).inertia(df).first()[0]
        assert inertia <= previous + 1e-9
        previous = inertia
    model = train_kmeans(df, init_centers=start)
    centers = start.copy()
    for _ in range(80):
        own = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[own == c].mean(axis=0) if (own == c).any() else centers[c] for c in range(3)])
    assert model.centers == pytest.approx(centers)
    assert by_id(model.transform(df), "prediction") == list(own)
    far = train_kmeans(df, init_centers=[[0, 0, 0, 0], [99, 99, 99, 99]], rounds=3)
    assert list(far.centers[1]) == [99] * 4
    drawn = train_kmeans(df, k=50)
    assert drawn.details["k"] == 50
    assert train_kmeans(df.repartition(3), k=50).centers == pytest.approx(drawn.centers)
    assert train_kmeans(df, k=1).centers.shape == (1, 4)
    with pytest.raises(ValueError):
        train_kmeans(df, k=0)


def sequential_dbscan(x, eps, min_pts):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) <= eps
    core = near.sum(axis=1) >= min_pts
    label, cluster = np.full(len(x), -1), 0
    for i in range(len(x)):
        if not core[i] or label[i] != -1:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if label[j] == -1 and j not in group:
                    group.add(j)
                    if core[j]:
                        todo.append(j)
        label[list(group)] = cluster
        cluster += 1
    return label, core


@pytest.mark.parametrize("eps", [0.45, 1.1, 1.5])
def test_dbscan_with_encoded_categories(spark, eps):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=(260, 2)), np.eye(3)[rng.integers(0, 3, 260)]])
    label, core = sequential_dbscan(x, eps, 5)
    got = dbscan(frame(spark, x), eps, 5).orderBy("_row_id").collect()
    assert [r["prediction"] for r in got] == list(label)
    only_flags = dbscan(frame(spark, x[:, 2:]), 0.5, 5).orderBy("_row_id").collect()
    assert [r["prediction"] for r in only_flags] == list(sequential_dbscan(x[:, 2:], 0.5, 5)[0])


@pytest.mark.parametrize("n,d,eps,min_pts,copies", [(300, 2, 0.2, 4, 0), (260, 3, 0.5, 5, 90), (200, 6, 1.2, 4, 0), (250, 1, 0.01, 3, 0)])
def test_dbscan(spark, n, d, eps, min_pts, copies):
    x = np.random.default_rng(n).normal(size=(n, d))
    x[:copies] = x[0] if copies else x[:0]
    label, core = sequential_dbscan(x, eps, min_pts)
    got = dbscan(frame(spark, x), eps, min_pts).orderBy("_row_id").collect()
    assert [r["prediction"] for r in got] == list(label)
    assert [r["is_core"] for r in got] == list(core)


def test_dbscan_model(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.1, (60, 2)), rng.normal(5, 0.1, (60, 2))])
    df = frame(spark, x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) + np.diag([np.inf] * 120)
    fifth = np.sort(np.sort(d, axis=1)[:, 4])
    eps = estimate_eps(df).first()[0]
    assert eps == pytest.approx(fifth[int(120 * 0.65)])
    model = train_dbscan(df)
    new = frame(spark, [[0.0, 0.0], [5.0, 5.0], [50.0, 50.0]])
    assert by_id(model.transform(new), "prediction") == [0, 1, -1]
    assert estimate_eps(frame(spark, [[1.0, 1.0]])).first()[0] == 1.0
    assert ev.cluster_summary(model.assignments).first()["clusters"] == 2


def test_pca(spark, data):
    x, _, _ = data
    x = x * [3, 1, 0.5, 0.1] + 4
    fitted = fit_pca(frame(spark, x))
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    assert fitted.eigenvalues == pytest.approx((values[-1], values[-2]), rel=1e-6)
    scores = fitted.transform(frame(spark, x))
    pc1 = np.array(by_id(scores, "pc1"))
    want = (x - x.mean(axis=0)) @ vectors[:, -1]
    assert np.abs(pc1) == pytest.approx(np.abs(want), abs=1e-4)
    flat = fit_pca(frame(spark, x[:, :1])).transform(frame(spark, x[:, :1]))
    assert by_id(flat, "pc1") == pytest.approx(list(x[:, 0])) and set(by_id(flat, "pc2")) == {0.0}


def test_metrics(spark):
    rows = [(0, 0.0, 0.0), (1, 0.0, 1.0), (2, 1.0, 1.0), (3, 1.0, 1.0), (4, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, label double, prediction double")
    got = {r["class_index"]: (r["precision"], r["recall"], r["f1"]) for r in ev.class_metrics(df, 4).collect()}
    want = [(0.5, 0.5, 0.5), (2 / 3, 1.0, 0.8), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    assert all(got[c] == pytest.approx(want[c]) for c in range(4))
    summary = ev.classification_metrics(df, 4).first()
    assert (summary["accuracy"], summary["macro_f1"]) == pytest.approx((0.6, 1.3 / 4))
    matrix = ev.confusion_matrix(df, 4)
    assert matrix.count() == 16 and matrix.agg(F.sum("n")).first()[0] == 5
    assert ev.confusion_view(df, ["a", "b", "c", "d"]).first()["pair"] == "a -> a"
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 4.0)], "label double, prediction double")
    assert tuple(ev.regression_metrics(flat).first())[:3] == pytest.approx((1.5, np.sqrt(2.5), -4.0))


def test_importance_and_signals(spark):
    ranked = ev.importance_ranking(spark, [0.5, -2.0, 0.5, 0.0], ["a", "b", "c", "d"]).collect()
    assert [(r["name"], r["percent"]) for r in ranked] == [("b", 100), ("a", 25), ("c", 25), ("d", 0)]
    assert ev.importance_ranking(spark, [0.0, 0.0], ["a", "b"]).count() == 0
    df = spark.createDataFrame([([1.0, -2.0, 0.0, 2.0, -1.0, 5.0],)], "features array<double>")
    strengths = F.transform("features", lambda v: F.abs(v))
    signals = df.select(ex.main_signals(strengths, list("abcdef")).alias("s")).first()["s"]
    assert [(s["name"], s["direction"]) for s in signals] == [("f", "above typical"), ("b", "below typical"), ("d", "above typical"), ("a", "above typical")]


def test_explanations(spark):
    p = spark.createDataFrame([([0.2, 0.5, 0.3],), ([0.4, 0.4, 0.2],)], "probability array<double>")
    rows = ex.explain_classes(p, ["a", "b", "c"]).collect()
    assert rows[0]["headline"] == "Predicted class: b" and rows[0]["why"].endswith("50%.") and rows[0]["why_not"].startswith("c was not")
    assert rows[1]["headline"] == "Predicted class: a" and rows[1]["why_not"].startswith("b was not")
    one = ex.explain_classes(spark.createDataFrame([([1.0],)], "probability array<double>"), ["only"]).first()
    assert one["why_not"].startswith("No competing class")
    clusters = spark.createDataFrame([(2,), (-1,)], "prediction int")
    assert [r["headline"] for r in ex.explain_clusters(clusters).collect()] == ["Assigned cluster: 2", "Assigned cluster: Noise / outlier"]


def test_dispatch_errors(spark, data):
    _, _, df = data
    with pytest.raises(ValueError, match="Unsupported"):
        train("regression", "kmeans", df)
    with pytest.raises(ValueError, match="No training rows"):
        train("classification", "naiveBayes", df.limit(0))
