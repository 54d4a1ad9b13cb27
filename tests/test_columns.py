"""Exact splits from column blocks: values that run over many blocks, copies, and the way of wide tables."""

import numpy as np
import pytest

from tabml.operators.learners import columns
from tabml.operators.training import train
from tests.test_learners import by_id, frame, plain_tree


def _rows(seed, n=300):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), np.where(rng.random(n) < 0.6, 1.0, rng.normal(size=n)), np.round(rng.normal(size=n), 1)], axis=1)
    y = ((x[:, 0] > 0.3) + (x[:, 1] > 1) * (x[:, 3] < 0)).astype(int)
    return x, y


@pytest.mark.parametrize("rows", [3, 50, 1 << 16])
def test_values_may_run_over_blocks(spark, monkeypatch, rows):
    monkeypatch.setattr(columns, "BLOCK_ROWS", rows)
    x, y = _rows(1)
    want = plain_tree(x, y, 3)
    model = train("classification", "treeClassifier", frame(spark, x, y), classes=3)
    assert np.array(by_id(model.transform(frame(spark, x)), "probability")) == pytest.approx(np.array([want(r) for r in x]))
    numbers = 5 * x[:, 2] - x[:, 3] ** 2
    value = plain_tree(x, numbers, None)
    model = train("regression", "treeRegressor", frame(spark, x, numbers))
    assert by_id(model.transform(frame(spark, x)), "prediction") == pytest.approx([value(r) for r in x])


@pytest.mark.parametrize("task,learner", [("classification", "forestClassifier"), ("regression", "forestRegressor")])
def test_forests_of_wide_tables_are_the_same(spark, monkeypatch, task, learner):
    x, y = _rows(2, 150)
    options = {"classes": 3} if task == "classification" else {}
    df = frame(spark, x, y)
    blocks = train(task, learner, df, **options)
    monkeypatch.setattr(columns, "MOST_FEATURES", 0)
    table = train(task, learner, df, **options)
    shape = lambda m: [(n.tree, n.number, n.feature, pytest.approx(n.threshold), pytest.approx(n.sums, abs=1e-9)) for n in m.nodes]
    assert [(n.tree, n.number, n.feature, n.threshold, n.sums) for n in blocks.nodes] == shape(table)


def test_a_level_shuffles_summaries_only(spark):
    x, y = _rows(3, 4000)
    df = frame(spark, x, y)
    blocks = columns.column_blocks(df, 4, columns.F.array(columns.F.lit(1)), 1, columns.F.col("_row_id"), block_rows=500)
    assert columns.root_sums(blocks, 1, 3) == [[float(v) for v in np.bincount(y, minlength=3)]]
    level = columns.Level(np.array([-1]), np.zeros(1), np.array([-1]), np.array([-1]), np.ones((1, 4), bool), np.array([np.bincount(y, minlength=3)], float), 1, 0, 3, {"min_rows": 4, "min_gain": 1e-9})
    fields = "j int, part int, seq int, node int, distinct long, first double, last double, sums array<double>"
    summaries = blocks.mapInArrow(columns._summaries(spark.sparkContext.broadcast(level)), fields)
    assert blocks.agg({"n": "sum"}).first()[0] == 4 * len(x)
    assert summaries.count() == blocks.count() < 80  # a row per block and open node, however many values
    assert summaries.select("distinct").groupBy().sum().first()[0] >= sum(len(np.unique(c)) for c in x.T)
