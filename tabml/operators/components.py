"""Connected components of an edge table by alternating star contraction.

Up to `SMALL_EDGES` edges are merged in one place, which saves the rounds. Beyond that, each round links every node to the smallest node it knows, in two grouped minimum joins; the number
of rounds grows with the logarithm of the longest path. Rounds are checkpointed to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.sources.scratch import checkpointed


SMALL_EDGES = 100_000


def connected_components(edges: DataFrame, small_edges: int | None = None) -> DataFrame:
    """`(node, component)` for nodes with at least one edge `(src, dst)`; component is the smallest node."""
    limit = SMALL_EDGES if small_edges is None else small_edges
    links = checkpointed(_oriented(edges.select("src", "dst")))
    if links.count() <= limit:
        return _merged(links.sparkSession, links.toPandas())
    mark = _mark(links)
    while True:
        links = checkpointed(_small_star(_large_star(links)))
        now = _mark(links)
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("dst").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def _merged(spark, links) -> DataFrame:
    """Components of a checked number of edges: smallest labels spread until nothing changes."""
    names, ends = np.unique(links.to_numpy(), return_inverse=True)
    ends = ends.reshape(-1, 2)
    label = np.arange(len(names))
    while True:
        low = label.copy()
        np.minimum.at(low, ends[:, 0], label[ends[:, 1]])
        np.minimum.at(low, ends[:, 1], label[ends[:, 0]])
        low = low[low]
        if np.array_equal(low, label):
            break
        label = low
    table = pd.DataFrame({"node": names, "component": names[label] if len(names) else names})
    return spark.createDataFrame(table.astype("int64"), "node bigint, component bigint")


def _oriented(edges: DataFrame) -> DataFrame:
    """From the larger to the smaller node, without loops and copies."""
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
    larger = both.join(low, "src").where(F.col("dst") > F.col("src"))
    return larger.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("src").agg(F.min("dst").alias("low"))
    moved = links.join(low, "src").where(F.col("dst") != F.col("low")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(low.select("src", F.col("low").alias("dst"))).distinct()


def _mark(links: DataFrame) -> tuple:
    """Size and content hash of an edge set, to see whether a round changed it."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return row[0], row[1]
