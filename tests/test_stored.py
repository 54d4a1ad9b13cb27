"""Models written and read back, batches of a stream written once, softmax steps in one task and in many, many classes."""

import numpy as np
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from tabml.operators import preprocess
from tabml.operators.learners import softmax
from tabml.operators.training import train
from tabml.plans.pipeline import analyze, load_trained, train_and_evaluate
from tabml.sources.models import load_model, save_model
from tabml.streaming.scoring import batch_writer
from tests.test_learners import by_id, frame

LEARNERS = [
    ("classification", "logistic", {}), ("classification", "knnClassifier", {}), ("classification", "knnClassifier", {"small_bytes": 0}), ("classification", "naiveBayes", {}),
    ("classification", "treeClassifier", {}), ("classification", "treeClassifier", {"method": "bins"}), ("classification", "forestClassifier", {}),
    ("classification", "forestClassifier", {"method": "bins"}), ("regression", "linearRegression", {}), ("regression", "knnRegressor", {}),
    ("regression", "treeRegressor", {}), ("regression", "forestRegressor", {}), ("unsupervised", "kmeans", {}), ("unsupervised", "dbscan", {}),
]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(120, 3))
    return x, frame(spark, x, (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.8))


@pytest.mark.parametrize("task,learner,options", LEARNERS, ids=[f"{a}-{i}" for i, (_, a, _) in enumerate(LEARNERS)])
def test_a_stored_learner_scores_alike(spark, rows, tmp_path, task, learner, options):
    x, df = rows
    options = options | ({"classes": 3} if task == "classification" else {})
    model = train(task, learner, df, **options)
    save_model(spark, model, str(tmp_path / "m"))
    other = spark.newSession()
    back = load_model(other, str(tmp_path / "m"))
    new = np.random.default_rng(1).normal(size=(30, 3))
    for column in ["prediction"] + (["probability"] if task == "classification" else []):
        want, got = by_id(model.transform(frame(spark, new)), column), by_id(back.transform(frame(other, new)), column)
        assert np.asarray(got, float) == pytest.approx(np.asarray(want, float))
    assert back.kind == model.kind and list(back.importances) == pytest.approx(list(model.importances))
    with pytest.raises(Exception):
        save_model(spark, model, str(tmp_path / "m"))


def _labelled(spark):
    return spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), F.concat(F.lit("c"), F.col("id") % 3).alias("b"), F.concat(F.lit("y"), F.col("id") % 7 % 4).alias("y"))


@pytest.mark.parametrize("limit", [100_000, 3])
def test_a_stored_flow_explains_alike_with_any_number_of_classes(spark, monkeypatch, tmp_path, limit):
    plain = train_and_evaluate(analyze(_labelled(spark), "y", key="id"), "naiveBayes")
    want = {r["id"]: (r["headline"], r["why"], r["why_not"]) for r in plain.explain(_labelled(spark)).collect()}
    monkeypatch.setattr(preprocess, "MAX_DRIVER_CLASSES", limit)
    found = train_and_evaluate(analyze(_labelled(spark), "y", key="id"), "naiveBayes")
    assert (found.analysis.preprocessor.classes is None) == (limit == 3)
    body = found.analysis.preprocessor.summary(spark).collect()[-1]["body"]
    assert ("4 classes" in body) == (limit == 3)
    found.save(str(tmp_path / "t"))
    for t in (found, load_trained(spark.newSession(), str(tmp_path / "t"))):
        explained = t.explain(_labelled(t.metrics.sparkSession)).collect()
        assert {r["id"]: (r["headline"], r["why"], r["why_not"]) for r in explained} == want
        scored = t.score(_labelled(t.metrics.sparkSession)).select("id", "predicted_label").collect()
        assert all(want[r["id"]][0].endswith(r["predicted_label"]) for r in scored)


def test_a_repeated_batch_is_written_once(spark, tmp_path):
    write = batch_writer(lambda df: df.withColumn("s", F.col("id") * 2), str(tmp_path / "out"))
    write(spark.range(5), 0)
    write(spark.range(5, 9), 1)
    write(spark.range(5, 9), 1)  # after a failure
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["id"], r["s"]) for r in got.collect()) == [(i, 2 * i) for i in range(9)]


def test_softmax_steps_in_one_task_and_in_many_agree(spark, rows, monkeypatch):
    x, df = rows
    copies = df.unionByName(df).unionByName(df.where("label = 1"))
    one = train("classification", "logistic", copies, classes=4, epochs=40).weights
    monkeypatch.setattr(softmax, "ONE_TASK", 0)
    many = train("classification", "logistic", copies, classes=4, epochs=40).weights
    assert one == pytest.approx(many)
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.8)
    full = np.concatenate([x, x, x[y == 1]])
    label = np.concatenate([y, y, y[y == 1]])
    a, w = np.column_stack([np.ones(len(full)), full]), np.zeros((4, 4))
    for _ in range(40):
        p = np.exp(a @ w.T)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(label)), label] -= 1
        step = p.T @ a / len(label)
        step[:, 1:] += 0.001 * w[:, 1:]
        w = w - 0.08 * step
    assert one == pytest.approx(w)


def test_a_softmax_step_is_one_stage_of_few_tasks(spark, rows, monkeypatch):
    x, df = rows
    monkeypatch.setattr(softmax, "ONE_TASK", 0)
    monkeypatch.setattr(softmax, "BLOCK_ROWS", 16)
    monkeypatch.setattr(RDD, "treeAggregate", None)  # two stages and a shuffle a step
    kept, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: kept.append(self.getNumPartitions()) or collect(self))
    train("classification", "logistic", df.repartition(50), classes=4, epochs=3)
    assert len(kept) >= 3 and max(kept) <= spark.sparkContext.defaultParallelism
    assert softmax.part_count(100, 3, 8) == 7 and softmax.part_count(10**9, 3, 8) == 179
