"""Best splits of all open nodes from sorted column blocks, without shuffling values again at each level.

Once per training every feature's values are sorted over the cluster, together with the rows they belong to, and
written as blocks of at most `BLOCK_ROWS` rows. A level then reads the blocks twice and shuffles summaries only:

1. Each block finds the node of its rows and reports, per open node, how many distinct values it holds, the first and
   the last of them, and the label sums. These summaries merge exactly: blocks of a feature are in order of
   value, so a value that two blocks share is the last of one and the first of the next. Running sums over the blocks
   give the exact rank of every block's values within its node.
2. Split candidates stand at every `step`-th distinct value of a node, so their ranks name the few blocks and positions
   that hold them. Only there are label sums taken up to single values; each block reports its best candidate per node.

The driver gets one row per open node and level, and one per candidate position (at most `2 * TREE_CANDIDATES` per node and feature,
whatever the number of rows).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.sources.scratch import stored

BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 16 << 20
# Each feature's block holds whole rows; beyond this many features that would multiply the data too much.
MOST_FEATURES = 64
_BLOCK = "j int, part int, seq int, n int, value binary, row binary, label binary, draws binary"


@dataclass
class Level:
    """Nodes so far as arrays, and for each node whether it is open for a feature."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    open: np.ndarray  # nodes x features
    totals: np.ndarray  # nodes x measures
    trees: int
    depth: int
    classes: int | None
    limits: dict


def column_blocks(rows: DataFrame, width: int, draws: Column, trees: int, salt: Column, block_rows: int | None = None) -> DataFrame:
    """Blocks of sorted values per feature from `(features, label)`; stored.

    `salt` lets copies of a value, however many, be cut over several tasks.
    """
    size = min(block_rows or BLOCK_ROWS, max(256, BLOCK_BYTES // (8 * (width + 2) + trees)))
    each = F.posexplode("features").alias("j", "value")
    long = rows.select("features", F.col("label").cast("double").alias("label"), draws.cast("array<int>").alias("draws"), salt.alias("salt")).select("*", each)
    order = ["j", "value", "salt"]
    sorted_rows = long.repartitionByRange(*order).sortWithinPartitions("j", "value")
    packed = sorted_rows.select(F.spark_partition_id().alias("part"), "j", "value", "features", "label", "draws").mapInArrow(_packed(size, width, trees), _BLOCK)
    return stored(packed, "column-blocks")


def _packed(size: int, width: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count, now, seq = 0, None, 0

        def given() -> pa.RecordBatch:
            nonlocal held, count, seq
            value, row, label, drawn = (np.concatenate(x) for x in zip(*held))
            seq += 1
            columns = [
                *(pa.array([v], pa.int32()) for v in (now[1], now[0], seq, len(value))),
                *(pa.array([v.tobytes()], pa.binary()) for v in (value, row, label, drawn)),
            ]
            held, count = [], 0
            return pa.RecordBatch.from_arrays(columns, ["j", "part", "seq", "n", "value", "row", "label", "draws"])

        for batch in batches:
            part, j = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            value = batch.column(2).to_numpy(zero_copy_only=False) + 0.0
            row = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            label = batch.column(4).to_numpy(zero_copy_only=False)
            drawn = batch.column(5).flatten().to_numpy(zero_copy_only=False).astype(np.int8).reshape(-1, trees)
            cuts = np.flatnonzero(np.diff(j)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(j)]):
                while a < b:
                    key = (int(part[a]), int(j[a]))
                    if held and (key != now or count >= size):
                        yield given()
                    now = key
                    to = min(b, a + size - count)
                    held.append((value[a:to], row[a:to], label[a:to], drawn[a:to]))
                    count += to - a
                    a = to
        if held:
            yield given()

    return run


def _measures(label: np.ndarray, weight: np.ndarray, classes: int | None) -> np.ndarray:
    """Weighted label sums of single rows: one per class, or count, sum and sum of squares."""
    if classes:
        out = np.zeros((len(label), classes))
        out[np.arange(len(label)), label.astype(np.int64)] = weight
        return out
    return np.stack([weight, weight * label, weight * label * label], axis=1)


def root_sums(blocks: DataFrame, trees: int, classes: int | None) -> list[list[float]]:
    """Label sums of all rows, per tree, from the blocks of the first feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for block in _blocks_in(batches):
            label = np.frombuffer(block["label"])
            draws = np.frombuffer(block["draws"], np.int8).reshape(block["n"], -1).astype(float)
            total = total + draws.T @ _measures(label, np.ones(len(label)), classes)
        if isinstance(total, np.ndarray):
            tree, measure = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(tree.ravel(), pa.int32()), pa.array(measure.ravel(), pa.int32()), pa.array(total.ravel())], ["tree", "m", "v"])

    found = blocks.where("j = 0").mapInArrow(run, "tree int, m int, v double").groupBy("tree", "m").agg(F.sum("v").alias("v")).collect()
    sums = [[0.0] * (classes or 3) for _ in range(trees)]
    for r in found:
        sums[r["tree"]][r["m"]] = r["v"]
    return sums


def _segments(block: dict, level: Level):
    """Rows of a block that belong to open nodes, ordered by node and value: node, value, measures, and where a distinct value begins."""
    n, j = block["n"], block["j"]
    value = np.frombuffer(block["value"])
    rows = np.frombuffer(block["row"]).reshape(n, -1)
    label = np.frombuffer(block["label"])
    draws = np.frombuffer(block["draws"], np.int8).reshape(n, -1)
    nodes, spots = [], []
    for tree in range(level.trees):
        spot = np.flatnonzero(draws[:, tree])
        at = np.full(len(spot), tree)
        for _ in range(level.depth):
            feature = level.feature[at]
            inner = feature >= 0  # rows in a leaf above this level belong to no open node
            if not inner.all():
                spot, at, feature = spot[inner], at[inner], feature[inner]
            at = np.where(rows[spot, feature] <= level.threshold[at], level.left[at], level.right[at])
        wanted = level.open[at, j]
        nodes.append(at[wanted])
        spots.append(spot[wanted] * level.trees + tree)
    node, spot = np.concatenate(nodes), np.concatenate(spots)
    # within a node rows stay in order of value; numbers of 16 bits are sorted by their digits
    order = np.argsort(node.astype(np.uint16) if len(level.feature) <= 1 << 16 else node, kind="stable")
    node, spot = node[order], spot[order]
    row, tree = spot // level.trees, spot % level.trees
    value = value[row]
    fresh = np.ones(len(node), bool)
    fresh[1:] = (node[1:] != node[:-1]) | (value[1:] != value[:-1])
    return node, value, _measures(label[row], draws[row, tree].astype(float), level.classes), np.flatnonzero(fresh)


def _blocks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def _summaries(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = sent.value
        for block in _blocks_in(batches):
            if not level.open[:, block["j"]].any():
                continue
            node, value, measures, at = _segments(block, level)
            if not len(node):
                continue
            begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            end = np.append(begin[1:], len(node))
            sums = np.add.reduceat(measures, begin)
            k = len(begin)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.full(k, block[c]), pa.int32()) for c in ("j", "part", "seq")),
                    pa.array(node[begin], pa.int32()),
                    pa.array(np.searchsorted(at, end) - np.searchsorted(at, begin), pa.int64()),
                    pa.array(value[begin]),
                    pa.array(value[end - 1]),
                    pa.array(list(sums)),
                ],
                ["j", "part", "seq", "node", "distinct", "first", "last", "sums"],
            )

    return run


def _targets(summaries: DataFrame, measures: int) -> DataFrame:
    """Positions of split candidates: block, node, rank `i`, place among the block's distinct values, sums of the blocks before, next block's first value."""
    order = Window.partitionBy("node", "j").orderBy("part", "seq")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("node", "j")
    # a value that goes on in the next block is counted there, where its last copy is
    met = summaries.withColumn("following", F.lead("first").over(order))
    met = met.withColumn("own", F.col("distinct") - F.coalesce((F.col("following") == F.col("last")).cast("int"), F.lit(0)))
    met = met.select(
        "*",
        F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset"),
        F.sum("own").over(whole).alias("all"),
        *[F.coalesce(F.sum(F.col("sums")[m]).over(before), F.lit(0.0)).alias(f"b{m}") for m in range(measures)],
    )
    step = F.greatest(F.lit(1).cast("long"), F.floor(F.col("all") / fixed.TREE_CANDIDATES))
    first = F.floor(F.col("offset") / step) + 1
    last = F.floor(F.least(F.col("offset") + F.col("own"), F.col("all") - 1) / step)
    ranks = F.when(first <= last, F.transform(F.sequence(first, last), lambda q: q * step))
    return met.select("j", "part", "seq", "node", "offset", "following", F.array(*[f"b{m}" for m in range(measures)]).alias("before"), F.explode(ranks).alias("i"))


def impurity(parts: np.ndarray, classes: int | None) -> np.ndarray:
    """Gini of class counts, or variance from count, sum and sum of squares; by row."""
    if classes is None:
        n, total, squares = parts.T
        return np.maximum(0.0, squares / n - (total / n) * (total / n))
    n = parts.sum(axis=1)
    shares = parts / n[:, None]
    squares = shares * shares
    total = squares[:, 0].copy()
    for c in range(1, classes):
        total += squares[:, c]
    return 1 - total


def _best(sent, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, targets = sent.value, wanted.value
        for block in _blocks_in(batches):
            if (held := targets.get((block["j"], block["part"], block["seq"]))) is None:
                continue
            node, value, measures, at = _segments(block, level)
            # running sums by distinct value; differences at node borders take off what comes before the node
            upto = np.cumsum(measures, axis=0)
            ends = np.append(at[1:], len(node)) - 1
            begin = np.searchsorted(node, held["node"])
            place = np.searchsorted(at, begin) + held["i"] - held["offset"] - 1
            base = np.where((begin > 0)[:, None], upto[begin - 1], 0.0)
            left = held["before"] + upto[ends[place]] - base
            inside = np.searchsorted(node, held["node"], side="right")
            following = np.append(at, len(node))[place + 1]
            other = np.where(following < inside, value[np.minimum(following, len(node) - 1)], held["following"])
            threshold = (value[at[place]] + other) / 2
            whole = level.totals[held["node"]]
            right = whole - left
            n, n_left, n_right = (p.sum(axis=1) if level.classes else p[:, 0] for p in (whole, left, right))
            fit = np.flatnonzero((n_left >= level.limits["min_rows"]) & (n_right >= level.limits["min_rows"]))
            if not len(fit):
                continue
            weighted = (n_left / n)[fit] * impurity(left[fit], level.classes) + (n_right / n)[fit] * impurity(right[fit], level.classes)
            gain = impurity(whole[fit], level.classes) - weighted
            order = np.lexsort((held["i"][fit], -gain, held["node"][fit]))
            lead = order[np.flatnonzero(np.append(True, np.diff(held["node"][fit][order]) != 0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(held["node"][fit][lead], pa.int32()),
                    pa.array(gain[lead]),
                    pa.array(np.full(len(lead), -block["j"]), pa.int32()),
                    pa.array(-held["i"][fit][lead], pa.int64()),
                    pa.array(threshold[fit][lead]),
                    pa.array(list(left[fit][lead])),
                ],
                ["node", "gain", "j", "i", "threshold", "left"],
            )

    return run


def best_splits(blocks: DataFrame, level: Level) -> dict[int, tuple[float, int, float, list[float]]]:
    """Per open node: gain, feature, threshold and the label sums of its left side; the lowest feature and threshold on ties."""
    context, measures = blocks.sparkSession.sparkContext, level.totals.shape[1]
    sent = context.broadcast(level)
    fields = "j int, part int, seq int, node int, distinct long, first double, last double, sums array<double>"
    found = _targets(blocks.mapInArrow(_summaries(sent), fields), measures).toArrow()
    if not found.num_rows:
        return {}
    columns = {c: found[c].to_numpy() for c in ("j", "part", "seq", "node", "offset", "i")}
    columns["following"] = found["following"].to_numpy(zero_copy_only=False).astype(float)
    columns["before"] = found["before"].combine_chunks().flatten().to_numpy().reshape(-1, measures)
    order = np.lexsort((columns["i"], columns["node"], columns["seq"], columns["part"], columns["j"]))
    key = np.stack([columns[c][order] for c in ("j", "part", "seq")], axis=1)
    cuts = np.flatnonzero(np.append(True, (np.diff(key, axis=0) != 0).any(axis=1)))
    targets = {tuple(int(v) for v in key[a]): {c: v[order[a:b]] for c, v in columns.items()} for a, b in zip(cuts, [*cuts[1:], len(key)])}
    wanted = context.broadcast(targets)
    each = blocks.mapInArrow(_best(sent, wanted), "node int, gain double, j int, i long, threshold double, left array<double>")
    best = each.groupBy("node").agg(F.max(F.struct("gain", "j", "i", "threshold", "left")).alias("b")).where(F.col("b.gain") > level.limits["min_gain"]).collect()
    sent.destroy()
    wanted.destroy()
    return {r["node"]: (r["b"]["gain"], -r["b"]["j"], r["b"]["threshold"], list(r["b"]["left"])) for r in best}
