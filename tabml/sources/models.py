"""Stored models: fitted preprocessors and learners written to a folder and read back in another session.

Parameters are one JSON line, tables are Parquet, and Spark's own learners are written by their own writers; all
of it goes through Spark, so the folder can lie wherever the session can write. A folder that holds something is refused.
"""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from tabml.operators.learners.base import FittedModel
from tabml.operators.learners.bayes import BayesModel
from tabml.operators.learners.dbscan import DbscanModel
from tabml.operators.learners.kmeans import KMeansModel
from tabml.operators.learners.knn import KnnModel
from tabml.operators.learners.linear import LinearModel
from tabml.operators.learners.softmax import SoftmaxModel
from tabml.operators.learners.trees import BinnedForestModel, BinnedTreeModel, GrownModel, Node
from tabml.operators.preprocess import CategoricalStats, NumericStats, TabularModel


def _write(spark: SparkSession, path: str, values: dict, tables: dict[str, DataFrame]) -> None:
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    # written last: a folder with values is whole
    spark.createDataFrame([(json.dumps(values),)], "value string").coalesce(1).write.text(f"{path}/values")


def read_values(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/values").first()[0])


def _plain(value):
    return value.tolist() if isinstance(value, np.ndarray) else value


def save_model(spark: SparkSession, model: FittedModel, path: str) -> None:
    """Write any of the learners' models."""
    values, tables = {"kind": type(model).__name__}, {}
    if isinstance(model, LinearModel):
        values |= {"weights": model.weights, "mean": model.mean, "std": model.std}
    elif isinstance(model, SoftmaxModel):
        values |= {"weights": _plain(model.weights)}
    elif isinstance(model, BayesModel):
        values |= {"priors": _plain(model.priors), "means": _plain(model.means), "variances": _plain(model.variances)}
    elif isinstance(model, KMeansModel):
        values |= {"centers": _plain(model.centers), "importances": model.importances, "rounds": model.details["rounds"]}
    elif isinstance(model, GrownModel):
        values |= {n: getattr(model, n) for n in ("trees", "depth", "importances", "classes", "middle")}
        values["nodes"] = [[_number(v) for v in (n.tree, n.number, n.feature, n.threshold, n.left, n.right)] + [[float(s) for s in n.sums]] for n in model.nodes]
    elif isinstance(model, (BinnedTreeModel, BinnedForestModel)):
        values["classes"] = model.classes
        model.fitted.write().save(f"{path}/fitted")
    elif isinstance(model, KnnModel):
        values |= {"key": model.key, "classes": model.classes, "small_bytes": model.small_bytes}
        tables["train"] = model.train
    elif isinstance(model, DbscanModel):
        values |= {"key": model.key, "eps": model.eps, "min_pts": model.min_pts, "importances": model.importances, "small_bytes": model.small_bytes}
        tables |= {"assignments": model.assignments, "clustered": model.clustered.select(model.key, "features")}
    else:
        raise ValueError(f"Can't store a {type(model).__name__}.")
    _write(spark, path, values, tables)


def _number(value):
    return value.item() if isinstance(value, np.generic) else value


def load_model(spark: SparkSession, path: str) -> FittedModel:
    values = read_values(spark, path)
    kind = values.pop("kind")
    if kind == "LinearModel":
        return LinearModel(np.array(values["weights"]), values["mean"], values["std"])
    if kind == "SoftmaxModel":
        return SoftmaxModel(np.array(values["weights"]))
    if kind == "BayesModel":
        return BayesModel(*[np.array(values[n]) for n in ("priors", "means", "variances")])
    if kind == "KMeansModel":
        return KMeansModel(np.array(values["centers"]), values["importances"], values["rounds"])
    if kind == "GrownModel":
        nodes = [Node(tree, number, sums, feature, threshold, left, right) for tree, number, feature, threshold, left, right, sums in values.pop("nodes")]
        return GrownModel(nodes, **values)
    if kind in ("BinnedTreeModel", "BinnedForestModel"):
        fitted = DefaultParamsReader.loadParamsInstance(f"{path}/fitted", spark)
        return (BinnedTreeModel if kind == "BinnedTreeModel" else BinnedForestModel)(fitted, values["classes"])
    if kind == "KnnModel":
        return KnnModel(spark.read.parquet(f"{path}/train"), values["key"], values["classes"], values["small_bytes"])
    train = spark.read.parquet(f"{path}/clustered")
    return DbscanModel(spark.read.parquet(f"{path}/assignments"), train, values["eps"], values["min_pts"], values["key"], values["importances"], values["small_bytes"])


def save_preprocessor(spark: SparkSession, model: TabularModel, path: str) -> None:
    values = {n: getattr(model, n) for n in ("target", "problem_type", "input_columns", "classes", "outlier_count", "missing_count")}
    values["numeric"] = {c: asdict(s) for c, s in model.numeric_stats.items()}
    values["categorical"] = {c: asdict(s) for c, s in model.categorical_stats.items()}
    values["many_classes"] = model.class_rows is not None
    _write(spark, path, values, {"classes": model.class_rows} if values["many_classes"] else {})


def load_preprocessor(spark: SparkSession, path: str) -> TabularModel:
    values = read_values(spark, path)
    return TabularModel(
        values["target"],
        values["problem_type"],
        values["input_columns"],
        {c: NumericStats(**s) for c, s in values["numeric"].items()},
        {c: CategoricalStats(**s) for c, s in values["categorical"].items()},
        values["classes"],
        values["outlier_count"],
        values["missing_count"],
        spark.read.parquet(f"{path}/classes") if values["many_classes"] else None,
    )
