"""Decision trees and forests.

`method="node"`, the default, takes split candidates from every node's own distinct values, exactly. Values are sorted
once into column blocks (`columns.py`), and each level merges small summaries of the blocks for all open nodes of all trees. With more
than `columns.MOST_FEATURES` features, where such blocks would multiply the data, a table of value frequencies is ranked
and summed per level instead. `method="bins"` uses Spark's tree learners, whose candidates are global quantile
bins; splits can differ.

A forest of the first kind draws rows and features by hashes of keys, so it does not depend on how the data is partitioned.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabml.functions import fixed, vectors
from tabml.functions.values import col
from tabml.operators.learners import columns
from tabml.operators.learners.base import FittedModel, class_count, vector, width
from tabml.operators.ordering import running_totals
from tabml.sources.rows import ROW_ID

MAX_BINS = 64
# A row is drawn k times with probability exp(-1) / k!, the limit of drawing n of n rows with
# replacement. Draws come from 32 hash bits; more than 12 draws are rarer than that resolution.
DRAW_BITS = 32
DRAW_STEPS = [
    math.floor(2**DRAW_BITS * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(12)
]


def subset_size(features: int) -> int:
    return max(1, int(features**0.5 + 0.5))


@dataclass
class Node:
    """A leaf with its label sums, or a split: rows with feature <= threshold go left."""

    tree: int
    number: int
    sums: list[float]
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1


class GrownModel(FittedModel):
    """One tree, or several that vote (classes, the lowest on ties) or are averaged (numbers)."""

    def __init__(self, nodes: list[Node], trees: int, depth: int, importances: list[float], classes: int | None, middle: float):
        super().__init__(importances, {"trees": trees, "leaves": sum(n.feature < 0 for n in nodes)})
        self.nodes, self.trees, self.depth, self.classes, self.middle = nodes, trees, depth, classes, middle
        shape = "forest" if trees > 1 else "tree"
        self.kind = shape + ("Classifier" if classes else "Regressor")
        self.has_probability = bool(classes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        reached = dataset.withColumn("_at", _leaves(self.nodes, self.trees, self.depth))
        if self.classes is None:
            values = vectors.array_literal([_mean(n.sums, self.middle) for n in self.nodes])
            total = F.aggregate("_at", F.lit(0.0), lambda s, i: s + F.get(values, i))
            return reached.withColumn("prediction", total / self.trees).drop("_at")
        if self.trees == 1:
            shares = vectors.array_literal([[v / sum(n.sums) for v in n.sums] for n in self.nodes])
            scored = reached.withColumn("probability", F.get(shares, F.col("_at")[0]))
        else:
            winner = vectors.index_literal([n.sums.index(max(n.sums)) for n in self.nodes])
            votes = F.transform("_at", lambda i: F.get(winner, i))
            scored = reached.withColumn("_votes", votes)
            counts = [_votes_for(c) / F.lit(float(self.trees)) for c in range(self.classes)]
            scored = scored.withColumn("probability", F.array(*counts)).drop("_votes")
        return scored.withColumn("prediction", vectors.argmax(F.col("probability"))).drop("_at")


def _votes_for(c: int) -> Column:
    return F.size(F.filter("_votes", lambda v: v == c)).cast("double")


class BinnedTreeModel(FittedModel):
    def __init__(self, fitted, classes: int | None):
        super().__init__(list(fitted.featureImportances.toArray()))
        self.fitted, self.classes = fitted, classes
        self.kind = "treeClassifier" if classes else "treeRegressor"
        self.has_probability = bool(classes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _apply(self.fitted, dataset, self.classes)


class BinnedForestModel(FittedModel):
    """Classes by hard votes of the trees, the lowest class on ties; numbers by their mean."""

    def __init__(self, fitted, classes: int | None):
        super().__init__(list(fitted.featureImportances.toArray()))
        self.fitted, self.classes = fitted, classes
        self.kind = "forestClassifier" if classes else "forestRegressor"
        self.has_probability = bool(classes)
        self.details = {"trees": fitted.getNumTrees}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.classes is None:
            return _apply(self.fitted, dataset, None)
        votes, voted = [], dataset.withColumn("_vector", vector())
        for i, tree in enumerate(self.fitted.trees):
            name = f"_vote{i}"
            voted = tree.setFeaturesCol("_vector").setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("").transform(voted)
            votes.append(name)
        shares = F.array(*[sum((F.col(v) == c).cast("double") for v in votes) / len(votes) for c in range(self.classes)])
        scored = voted.withColumn("probability", shares).drop("_vector", *votes)
        return scored.withColumn("prediction", vectors.argmax(F.col("probability")))


def _apply(fitted, dataset: DataFrame, classes: int | None) -> DataFrame:
    prepared = dataset.withColumn("_vector", vector())
    fitted.setFeaturesCol("_vector").setPredictionCol("prediction")
    if classes is None:
        return fitted.transform(prepared).drop("_vector")
    scored = fitted.setRawPredictionCol("").setProbabilityCol("_shares").transform(prepared)
    return scored.withColumn("probability", vector_to_array("_shares")).drop("_vector", "_shares")


def train_tree(df: DataFrame, task: str, classes: int | None = None, method: str = "node", max_bins: int = MAX_BINS) -> FittedModel:
    classes = (classes or class_count(df)) if task == "classification" else None
    if method == "node":
        return _grow(df, classes, fixed.TREE)
    settings = _settings(fixed.TREE, max_bins)
    learner = DecisionTreeClassifier(impurity="gini", **settings) if classes else DecisionTreeRegressor(**settings)
    return BinnedTreeModel(learner.fit(df.select("label", vector().alias("_vector"))), classes)


def train_forest(df: DataFrame, task: str, classes: int | None = None, method: str = "node", key: str = ROW_ID, max_bins: int = MAX_BINS) -> FittedModel:
    """`key` names the unique row id that `method="node"` draws by."""
    classes = (classes or class_count(df)) if task == "classification" else None
    trees, seed, subset = fixed.FOREST[f"{task}_trees"], fixed.FOREST["seed"], subset_size(width(df))
    if method == "node":
        return _grow(df, classes, fixed.FOREST, trees, subset, key)
    settings = {"numTrees": trees, "seed": seed, "featureSubsetStrategy": str(subset), **_settings(fixed.FOREST, max_bins)}
    learner = RandomForestClassifier(**settings) if classes else RandomForestRegressor(**settings)
    return BinnedForestModel(learner.fit(df.select("label", vector().alias("_vector"))), classes)


def _settings(values: dict, max_bins: int) -> dict:
    return {
        "featuresCol": "_vector", "labelCol": "label", "maxDepth": values["depth"], "minInstancesPerNode": values["min_rows"],
        "minInfoGain": values["min_gain"], "maxBins": max_bins,
    }


def _mean(sums: list[float], middle: float) -> float:
    return (sums[1] / sums[0] if sums[0] else 0.0) + middle


def _leaves(nodes: list[Node], trees: int, depth: int) -> Column:
    """Index of the node that a row reaches, per tree."""
    feature, left, right = (vectors.index_literal([getattr(n, name) for n in nodes]) for name in ("feature", "left", "right"))
    threshold = vectors.array_literal([n.threshold for n in nodes])

    def step(at: Column, _: Column) -> Column:
        below = F.get(F.col("features"), F.get(feature, at)) <= F.get(threshold, at)
        return F.when(F.get(feature, at) < 0, at).when(below, F.get(left, at)).otherwise(F.get(right, at))

    rounds = vectors.index_literal(range(depth))
    return F.transform(vectors.index_literal(range(trees)), lambda root: F.aggregate(rounds, root, step))


def _draws(key: str, trees: int) -> Column:
    """How often each tree draws the row."""
    steps = F.expr("array(" + ",".join(f"{s}L" for s in DRAW_STEPS) + ")")

    def draw(tree: int) -> Column:
        text = F.concat(F.lit(f"{fixed.FOREST['seed']}-{tree}-"), col(key).cast("string"))
        number = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("bigint")
        return vectors.bound(number, lambda n: F.size(F.filter(steps, lambda s: n >= s)))

    return F.array(*[draw(t) for t in range(trees)])


def chosen_features(tree: int, number: int, width: int, subset: int | None) -> list[int]:
    """Features a node may split on: those with the smallest hashes."""
    if subset is None or subset >= width:
        return list(range(width))
    def rank(j: int) -> str:
        return hashlib.md5(f"{fixed.FOREST['seed']}-{tree}-{number}-{j}".encode()).hexdigest()
    return sorted(sorted(range(width), key=rank)[:subset])


def _grow(df: DataFrame, classes: int | None, limits: dict, trees: int = 1, subset: int | None = None, key: str | None = None) -> GrownModel:
    # Sums of values around the mean keep the variance exact enough.
    middle = 0.0 if classes else float(df.agg(F.avg("label")).first()[0])
    centered = F.col("label") - F.lit(middle)
    measures = (
        {f"s{c}": (F.col("label") == c).cast("double") for c in range(classes)}
        if classes
        else {"s0": F.lit(1.0), "s1": centered, "s2": centered * centered}
    )
    names = list(measures)
    draws = _draws(key, trees) if key else F.array(F.lit(1))
    rows = _spread(df.select("features", "label", *([col(key)] if key else [])))
    salt = F.xxhash64(col(key)) if key else F.monotonically_increasing_id()
    rows = rows.select("features", centered.alias("label"), draws.alias("draws"), salt.alias("salt"), *[m.alias(n) for n, m in measures.items()])
    features = width(df)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # sorting into ranges reads them twice
    blocks = columns.column_blocks(rows, features, F.col("draws"), trees, F.col("salt")) if 0 < features <= columns.MOST_FEATURES else None
    if blocks is not None:
        rows.unpersist()
    try:
        if blocks is None:
            sums = rows.agg(*[F.sum(F.col("draws")[t] * F.col(n)).alias(f"{n}_{t}") for t in range(trees) for n in names]).first()
            roots = [[sums[f"{n}_{t}"] for n in names] for t in range(trees)]
        else:
            roots = columns.root_sums(blocks, trees, classes)
        nodes = [Node(t, 1, roots[t]) for t in range(trees)]
        importances = [0.0] * features
        level = list(range(trees))
        for depth in range(limits["depth"]):
            allowed = {i: chosen_features(nodes[i].tree, nodes[i].number, features, subset) for i in level if _splittable(nodes[i], classes, limits)}
            if not allowed:
                break
            if blocks is None:
                splits = _best_splits(rows, nodes, trees, depth, allowed, names, classes, limits)
            else:
                splits = columns.best_splits(blocks, _level(nodes, trees, depth, allowed, features, classes, limits))
            level = []
            for i, (gain, feature, threshold, left) in sorted(splits.items()):
                node = nodes[i]
                node.feature, node.threshold = feature, threshold
                importances[feature] += gain * (sum(node.sums) if classes else node.sums[0]) / trees
                right = [whole - part for whole, part in zip(node.sums, left)]
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [Node(node.tree, 2 * node.number, left), Node(node.tree, 2 * node.number + 1, right)]
                level += [node.left, node.right]
    finally:
        if blocks is None:
            rows.unpersist()
    return GrownModel(nodes, trees, limits["depth"], importances, classes, middle)


def _level(nodes: list[Node], trees: int, depth: int, allowed: dict, features: int, classes: int | None, limits: dict) -> columns.Level:
    opened = np.zeros((len(nodes), features), bool)
    for i, chosen in allowed.items():
        opened[i, chosen] = True
    feature, left, right = (np.array([getattr(n, name) for n in nodes]) for name in ("feature", "left", "right"))
    threshold = np.array([float(n.threshold) for n in nodes])
    return columns.Level(feature, threshold, left, right, opened, np.array([n.sums for n in nodes], float), trees, depth, classes, limits)


def _spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer partitions than cores, as one small file has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _best_splits(rows: DataFrame, nodes: list[Node], trees: int, depth: int, allowed: dict, names: list[str], classes: int | None, limits: dict) -> dict:
    """Per open node: gain, feature, threshold and the label sums of its left side."""
    nothing = vectors.index_literal([])
    choice = vectors.index_literal([allowed.get(i, []) for i in range(len(nodes))])
    at = _leaves(nodes, trees, depth)

    def cells(i: Column, tree: Column) -> Column:
        drawn = F.get(F.col("draws"), tree)
        return F.transform(
            F.when(drawn > 0, F.get(choice, i)).otherwise(nothing),
            lambda j: F.struct(i.alias("node"), j.alias("j"), F.get(F.col("features"), j).alias("v"), drawn.alias("w")),
        )

    # One row per open node a row belongs to and feature; equal values are summed before the shuffle.
    values = (
        rows.select(F.inline(F.flatten(F.transform(at, cells))), *names)
        .groupBy("node", "j", "v")
        .agg(*[F.sum(F.col("w") * F.col(n)).alias(n) for n in names])
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        upto = {"rank": F.lit(1), **{f"l_{n}": F.col(n) for n in names}}
        ranked = running_totals(values, ["node", "j"], ["v"], upto)
        totals = values.groupBy("node", "j").agg(F.count(F.lit(1)).alias("distinct"), *[F.sum(n).alias(f"t_{n}") for n in names])
        # A candidate lies between the values of rank i and i + 1, for every multiple i of the step.
        step = F.greatest(F.lit(1), F.floor(F.col("distinct") / fixed.TREE_CANDIDATES))
        sides = F.filter(
            F.array(F.struct(F.col("rank").alias("i"), F.lit(True).alias("low")), F.struct((F.col("rank") - 1).alias("i"), F.lit(False).alias("low"))),
            lambda s: (s["i"] > 0) & (s["i"] < F.col("distinct")) & (s["i"] % F.col("step") == 0),
        )
        # One row per open node and feature.
        around = ranked.drop(*names).join(F.broadcast(totals), ["node", "j"]).withColumn("step", step).withColumn("side", F.explode(sides))
        low = F.col("side.low")
        candidates = around.groupBy("node", "j", F.col("side.i").alias("i")).agg(
            ((F.max(F.when(low, F.col("v"))) + F.max(F.when(~low, F.col("v")))) / 2).alias("threshold"),
            *[F.max(F.when(low, F.col(f"l_{n}"))).alias(f"l_{n}") for n in names],
            *[F.max(f"t_{n}").alias(f"t_{n}") for n in names],
        )
        whole, left = [F.col(f"t_{n}") for n in names], [F.col(f"l_{n}") for n in names]
        right = [w - part for w, part in zip(whole, left)]
        size, size_left, size_right = (_size(p, classes) for p in (whole, left, right))
        weighted = (size_left / size) * _impurity(left, classes) + (size_right / size) * _impurity(right, classes)
        fit = candidates.where((size_left >= limits["min_rows"]) & (size_right >= limits["min_rows"]))
        fit = fit.withColumn("gain", _impurity(whole, classes) - weighted)
        # The largest gain, then the lowest feature and threshold.
        order = F.struct("gain", (-F.col("j")).alias("j"), (-F.col("i")).alias("i"), "threshold", *[f"l_{n}" for n in names])
        found = fit.groupBy("node").agg(F.max(order).alias("b")).where(F.col("b.gain") > limits["min_gain"]).collect()
        return {r["node"]: (r["b"]["gain"], -r["b"]["j"], r["b"]["threshold"], [r["b"][f"l_{n}"] for n in names]) for r in found}
    finally:
        values.unpersist()


def _size(parts: list[Column], classes: int | None) -> Column:
    return sum(parts[1:], parts[0]) if classes else parts[0]


def _impurity(parts: list[Column], classes: int | None) -> Column:
    """Gini of class counts, or variance from count, sum and sum of squares."""
    if classes is None:
        n, total, squares = parts
        return F.greatest(F.lit(0.0), squares / n - (total / n) * (total / n))
    n = _size(parts, classes)
    shares = [(p / n) * (p / n) for p in parts]
    return 1 - sum(shares[1:], shares[0])


def _splittable(node: Node, classes: int | None, limits: dict) -> bool:
    n = sum(node.sums) if classes else node.sums[0]
    if n <= limits["min_rows"]:
        return False
    if classes:
        spread = 1 - sum((v / n) ** 2 for v in node.sums)
    else:
        spread = node.sums[2] / n - (node.sums[1] / n) ** 2
    return spread > limits["min_gain"]
