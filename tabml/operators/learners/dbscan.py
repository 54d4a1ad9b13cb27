"""DBSCAN on a grid, or beyond `GRID_FEATURES` numeric features in balls with a halo (`halo.py`), without listing pairs of rows.

Space is cut into cells whose rows all lie within eps of each other. A cell with at least `min_pts`
rows therefore holds only core rows of one cluster, whatever its size, and is handled as one object
with a bounding box. Only rows of sparser cells, at most `min_pts - 1` per cell, are looked at one by
one. Two cells are linked when some pair of their core rows is within eps: boxes and single
representatives decide most cases, and the rest is settled by splitting the cells until they are decided.

The result is the sequential definition made order-free: core = enough rows within eps (itself
included), clusters = connected core rows numbered by their smallest row id, a border row joins the
lowest cluster among its core neighbours, everything else is noise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabml.functions import fixed, vectors
from tabml.functions.values import col
from tabml.operators.components import connected_components
from tabml.operators.learners.base import FittedModel, dispersion, width
from tabml.operators.learners.halo import dbscan_halo
from tabml.operators.neighbors import nearest_neighbors
from tabml.operators.ordering import dense_positions
from tabml.sources.rows import ROW_ID
from tabml.sources.scratch import checkpointed

# Rows of one cell compared in one task when single rows must be tested against it.
CHUNK_ROWS = 20_000
# Features used to find neighbouring cells by an equi-join.
JOIN_FEATURES = 3
# Bounds are trusted beyond this relative distance from eps; closer ones are tested exactly.
SLACK = 1e-9
# Parts per feature when undecided cells are split.
SPLIT = 4
# Cells are split along every numeric feature; with more of them the parts of a cell are too many.
GRID_FEATURES = 6


def estimate_eps(df: DataFrame, key: str = ROW_ID) -> DataFrame:
    """`(eps)`: the 0.65 quantile, by rank, of the distances of all rows to their fifth nearest other row.

    With fewer rows the farthest of the others counts; a distance of 0 counts as 1.
    """
    rows = df.select(col(key).alias("id"), "features")
    nth = fixed.DBSCAN["eps_neighbor"]
    if rows.isEmpty():
        return df.sparkSession.createDataFrame([(1.0,)], "eps double")
    found = nearest_neighbors(rows, rows, nth, "id", "id", exclude_self=True)
    away = found.groupBy("id").agg(F.max_by("distance", "rank").alias("away"))
    each = rows.select("id").join(away, "id", "left").select("id", _or_one(F.col("away")).alias("away"))
    placed = dense_positions(checkpointed(each), ["away", "id"], "at")
    pick = int(math.floor(placed.count() * fixed.DBSCAN["eps_quantile"]))
    return placed.where(F.col("at") == pick).select(F.col("away").alias("eps"))


def _or_one(value: Column) -> Column:
    return F.when(value.isNull() | (value == 0), F.lit(1.0)).otherwise(value)


def minimum_points(n: int) -> int:
    half_root = int(math.floor(n**0.5 / 2 + 0.5))
    return min(fixed.DBSCAN["min_pts_high"], max(fixed.DBSCAN["min_pts_low"], half_root))


class _Grid:
    """Cell geometry: bounding boxes and safe bounds between boxes and rows."""

    def __init__(self, size: int, eps: float, spread: list[float], flags: list[int], small_edges: int | None = None):
        """`flags` are features that are 0 or 1 in every row."""
        self.size, self.eps, self.small_edges = size, eps, small_edges
        # Below a distance of 1 near rows agree in every flag, so flags join by equality. A cell is
        # narrower than 1 then, and its rows differ in the other features only.
        self.equal = flags if eps < 1 - SLACK else []
        self.side = eps / math.sqrt(max(1, size - len(self.equal))) * (1 - SLACK)
        self.reach = int(math.ceil(eps / self.side)) + 1
        widest = sorted(set(range(size)) - set(self.equal), key=lambda j: -spread[j])
        self.axes = sorted(widest[:JOIN_FEATURES])

    def cell(self, features: Column, parts: int = 1) -> Column:
        return F.transform(features, lambda x: F.floor(x * F.lit(parts / self.side)))

    def box(self) -> list[Column]:
        axis = [F.col("features")[j] for j in range(self.size)]
        return [F.array(*[F.min(a) for a in axis]).alias("low"), F.array(*[F.max(a) for a in axis]).alias("high")]

    def gap(self, low_a, high_a, low_b, high_b) -> Column:
        """Smallest distance of two boxes."""
        zero = F.lit(0.0)
        forward = F.zip_with(low_b, high_a, lambda b, a: b - a)
        backward = F.zip_with(low_a, high_b, lambda a, b: a - b)
        return _norm(F.zip_with(forward, backward, lambda f, b: F.greatest(zero, f, b)))

    def span(self, low_a, high_a, low_b, high_b) -> Column:
        """Largest distance of two boxes."""
        forward = F.zip_with(high_b, low_a, lambda b, a: b - a)
        backward = F.zip_with(high_a, low_b, lambda a, b: a - b)
        return _norm(F.zip_with(forward, backward, lambda f, b: F.greatest(f, b)))

    def surely_within(self, distance: Column) -> Column:
        return distance <= F.lit(self.eps * (1 - SLACK))

    def maybe_within(self, distance: Column) -> Column:
        return distance <= F.lit(self.eps * (1 + SLACK))

    def within(self, a: Column, b: Column) -> Column:
        return F.sqrt(vectors.squared_distance(a, b)) <= F.lit(self.eps)

    def near_cells(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Cells of `right` that may hold a row within eps of a cell of `left`, the cell itself left out.

        Columns of the right side get the prefix `n_`. The equi-join runs on blocks of cells, so it
        needs no list of all neighbour offsets.
        """
        def block(cell: Column, j: int) -> Column:
            return F.floor(cell[j] / self.reach)

        digits = [F.floor(F.col("_shift") / 3**i) % 3 - 1 for i in range(len(self.axes))]
        same = [F.col("cell")[j] for j in self.equal]
        moved = [block(F.col("cell"), j) + digit for j, digit in zip(self.axes, digits)]
        around = left.withColumn("_shift", F.explode(F.sequence(F.lit(0), F.lit(3 ** len(self.axes) - 1))))
        around = around.withColumn("_block", F.array(*moved, *same))
        other = right.withColumn("_block", F.array(*[block(F.col("cell"), j) for j in self.axes], *same))
        other = other.select("_block", *[F.col(c).alias("n_" + c) for c in right.columns])
        joined = around.join(other, "_block").where(F.col("cell") != F.col("n_cell"))
        return joined.where(self.maybe_within(self.gap(F.col("low"), F.col("high"), F.col("n_low"), F.col("n_high")))).drop("_block", "_shift")


def _norm(parts: Column) -> Column:
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda total, x: total + x * x))


def _met_by_rows(pairs: DataFrame, rows: DataFrame, grid: _Grid) -> DataFrame:
    """Join (row p, cell n_cell with n_n rows) with the rows of that cell that are within eps.

    A hot cell is cut into chunks by row id; the few rows that ask for it are copied to each chunk.
    """
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n_n") / F.lit(CHUNK_ROWS)))
    asking = pairs.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)))
    cells = pairs.select("n_cell", chunks.alias("_chunks")).distinct()
    answering = (
        rows.select(F.col("cell").alias("n_cell"), F.col("id").alias("n_id"), F.col("features").alias("n_features"))
        .join(cells, "n_cell")
        .withColumn("_chunk", F.pmod(F.xxhash64("n_id"), F.col("_chunks")))
        .drop("_chunks")
    )
    return asking.join(answering, ["n_cell", "_chunk"]).where(grid.within(F.col("features"), F.col("n_features")))


def _flags(df: DataFrame, size: int) -> list[int]:
    """Positions of features that are 0 or 1 in every row, such as encoded categories."""
    values = [F.col("features")[j] for j in range(size)]
    row = df.agg(F.array(*[F.bool_and((x == 0) | (x == 1)) for x in values]).alias("flags")).first()
    return [j for j, flag in enumerate(row["flags"]) if flag]


def dbscan(df: DataFrame, eps: float, min_pts: int, key: str = ROW_ID, small_edges: int | None = None, method: str | None = None) -> DataFrame:
    """`(key, is_core, prediction)` for every row; noise is -1. `method`: `grid` or `halo`, else by the number of numeric features."""
    size = width(df)
    flags = _flags(df, size)
    if (method or ("halo" if size - len(flags) > GRID_FEATURES else "grid")) == "halo":
        return dbscan_halo(df.select(col(key).alias("id"), "features"), eps, min_pts, size, small_edges).withColumnRenamed("id", key)
    grid = _Grid(size, eps, dispersion(df), flags, small_edges)
    rows = df.select(col(key).alias("id"), "features").withColumn("cell", grid.cell(F.col("features")))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _cluster(rows, grid, min_pts).withColumnRenamed("id", key)
    finally:
        rows.unpersist()


def _cluster(rows: DataFrame, grid: _Grid, min_pts: int) -> DataFrame:
    cells = checkpointed(
        rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *grid.box(), F.min(F.struct("id", "features")).alias("first"))
    )
    dense = F.col("n") >= min_pts
    sparse_rows = checkpointed(rows.join(cells.where(~dense).select("cell", "n", "low", "high"), "cell"))

    # 1. Core rows of sparse cells: rows of their own cell, plus near cells counted as a whole when
    #    surely within eps and row by row otherwise.
    near = checkpointed(grid.near_cells(cells.where(~dense).select("cell", "low", "high"), cells.select("cell", "n", "low", "high")).select("cell", "n_cell", "n_n", "n_low", "n_high"))
    asked = sparse_rows.join(near, "cell").select("id", "features", "n_cell", "n_n", "n_low", "n_high")
    span = grid.span(F.col("features"), F.col("features"), F.col("n_low"), F.col("n_high"))
    gap = grid.gap(F.col("features"), F.col("features"), F.col("n_low"), F.col("n_high"))
    asked = asked.withColumn("_whole", grid.surely_within(span)).where(F.col("_whole") | grid.maybe_within(gap))
    whole = asked.where("_whole").groupBy("id").agg(F.sum("n_n").alias("m"))
    single = _met_by_rows(asked.where(~F.col("_whole")).select("id", "features", "n_cell", "n_n"), rows, grid)
    single = single.groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    counts = sparse_rows.select("id", F.col("n").alias("m")).unionByName(whole).unionByName(single)
    core_ids = counts.groupBy("id").agg(F.sum("m").alias("m")).where(F.col("m") >= min_pts).select("id")
    sparse_core = checkpointed(sparse_rows.select("cell", "id", "features").join(core_ids, "id"))

    # 2. One node per cell with core rows, named by its smallest core row.
    sparse_nodes = sparse_core.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), *grid.box(), F.min(F.struct("id", "features")).alias("first")
    )
    nodes = checkpointed(
        cells.where(dense).withColumn("dense", F.lit(True)).unionByName(sparse_nodes.withColumn("dense", F.lit(False)))
        .select("cell", "n", "low", "high", "dense", F.col("first.id").alias("node"), F.col("first.features").alias("point"))
    )
    members = _cluster_nodes(nodes, rows, sparse_core, grid)

    # 3. Border rows: the lowest cluster among the near cells with a core row within eps.
    named = nodes.join(members, "node")
    border = sparse_rows.select("id", "cell", "features").join(sparse_core.select("id"), "id", "left_anti")
    border = checkpointed(border)
    own = border.join(named.select("cell", "cluster"), "cell").select("id", "cluster")
    border_cells = border.select("cell").distinct().join(cells.select("cell", "low", "high"), "cell")
    beside = grid.near_cells(border_cells, named.select("cell", "n", "low", "high", "cluster")).select("cell", "n_cell", "n_n", "n_low", "n_high", "n_cluster")
    tested = border.join(beside, "cell").withColumn("_whole", grid.surely_within(span)).where(F.col("_whole") | grid.maybe_within(gap))
    core_rows = sparse_core.select("id", "features", "cell").unionByName(
        rows.join(cells.where(dense).select("cell"), "cell", "left_semi").select("id", "features", "cell")
    )
    touching = _met_by_rows(tested.where(~F.col("_whole")).select("id", "features", "n_cell", "n_n", "n_cluster"), core_rows, grid)
    reached = (
        own.unionByName(tested.where("_whole").select("id", F.col("n_cluster").alias("cluster")))
        .unionByName(touching.select("id", F.col("n_cluster").alias("cluster")))
        .groupBy("id").agg(F.min("cluster").alias("cluster"))
    )

    # 4. Labels: per cell for dense cells, per row for the others.
    cell_label = named.select("cell", "dense", F.col("cluster").alias("_cell_cluster"))
    core_label = sparse_core.select("id", "cell").join(cell_label.select("cell", "_cell_cluster"), "cell")
    row_label = core_label.select("id", F.lit(True).alias("is_core"), F.col("_cell_cluster").alias("cluster")).unionByName(
        border.select("id").join(reached, "id", "left").select("id", F.lit(False).alias("is_core"), "cluster")
    )
    in_dense = rows.join(cell_label.where("dense"), "cell").select("id", F.lit(True).alias("is_core"), F.col("_cell_cluster").alias("cluster"))
    labels = in_dense.unionByName(row_label)
    noise = F.lit(fixed.DBSCAN["noise"])
    return checkpointed(labels.select("id", "is_core", F.coalesce(F.col("cluster"), noise).cast("int").alias("prediction")))


def _cluster_nodes(nodes: DataFrame, rows: DataFrame, sparse_core: DataFrame, grid: _Grid) -> DataFrame:
    """`(node, cluster)`: linked cells share a cluster, clusters are numbered by their smallest row."""
    small = nodes.select("cell", "low", "high", "node", "point")
    pairs = grid.near_cells(small, small).where(F.col("node") > F.col("n_node"))
    span = grid.span(F.col("low"), F.col("high"), F.col("n_low"), F.col("n_high"))
    linked = grid.surely_within(span) | grid.within(F.col("point"), F.col("n_point"))
    pairs = checkpointed(pairs.select("cell", "n_cell", F.col("node").alias("src"), F.col("n_node").alias("dst"), linked.alias("linked")))
    edges = pairs.where("linked").select("src", "dst")
    groups = _grouped(nodes, edges, grid.small_edges)

    # Undecided pairs matter only between different groups.
    open_pairs = _across(pairs.where("NOT linked").select("src", "dst", "cell", "n_cell"), groups)
    dense_rows = rows.join(nodes.where("dense").select("cell"), "cell", "left_semi").select("id", "features", "cell")
    core_rows = dense_rows.unionByName(sparse_core.select("id", "features", "cell"))
    parts = 1
    open_pairs = checkpointed(open_pairs.withColumn("sub", F.col("cell")).withColumn("n_sub", F.col("n_cell")))
    found = None
    while not open_pairs.isEmpty():
        parts *= SPLIT
        links, open_pairs = _split(open_pairs, core_rows, grid, parts)
        found = links if found is None else found.unionByName(links)
    if found is not None:
        groups = _grouped(nodes, checkpointed(edges.unionByName(found)), grid.small_edges)
    roots = dense_positions(groups.select("component").distinct(), ["component"], "cluster")
    return checkpointed(groups.join(roots, "component").select("node", "cluster"))


def _grouped(nodes: DataFrame, edges: DataFrame, small_edges: int | None) -> DataFrame:
    components = connected_components(edges, small_edges)
    return checkpointed(
        nodes.select("node").join(components, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    )


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select(F.col("node").alias("src"), F.col("component").alias("_a"))
    b = groups.select(F.col("node").alias("dst"), F.col("component").alias("_b"))
    return pairs.join(a, "src").join(b, "dst").where(F.col("_a") != F.col("_b")).drop("_a", "_b")


def _split(open_pairs: DataFrame, core_rows: DataFrame, grid: _Grid, parts: int) -> tuple[DataFrame, DataFrame]:
    """Split the open cells along every feature; link, drop or keep the pairs of parts.

    Cells shrink to single points, for which the distance of the representatives is exact.
    """
    previous = grid.cell(F.col("features"), parts // SPLIT) if parts > SPLIT else F.col("cell")
    wanted = open_pairs.select("cell", "sub").unionByName(open_pairs.select(F.col("n_cell").alias("cell"), F.col("n_sub").alias("sub"))).distinct()
    pieces = (
        core_rows.withColumn("sub", previous)
        .join(wanted, ["cell", "sub"], "left_semi")
        .withColumn("piece", grid.cell(F.col("features"), parts))
        .groupBy("cell", "sub", "piece")
        .agg(*grid.box(), F.min(F.struct("id", "features")).alias("first"))
        .select("cell", "sub", "piece", "low", "high", F.col("first.features").alias("point"))
    )
    pieces = checkpointed(pieces)
    left = open_pairs.join(pieces, ["cell", "sub"])
    right = pieces.select(*[F.col(c).alias("n_" + c) for c in pieces.columns])
    span = grid.span(F.col("low"), F.col("high"), F.col("n_low"), F.col("n_high"))
    gap = grid.gap(F.col("low"), F.col("high"), F.col("n_low"), F.col("n_high"))
    exact = (F.col("low") == F.col("high")) & (F.col("n_low") == F.col("n_high"))
    linked = grid.surely_within(span) | grid.within(F.col("point"), F.col("n_point"))
    both = (
        left.join(right, ["n_cell", "n_sub"])
        .where(grid.maybe_within(gap))
        .select("src", "dst", "cell", "n_cell", F.col("piece").alias("sub"), F.col("n_piece").alias("n_sub"), linked.alias("linked"), exact.alias("exact"))
    )
    both = checkpointed(both)
    links = both.where("linked").select("src", "dst").distinct()
    rest = both.where("NOT linked AND NOT exact").join(links, ["src", "dst"], "left_anti")
    return links, checkpointed(rest.select("src", "dst", "cell", "n_cell", "sub", "n_sub"))


class DbscanModel(FittedModel):
    kind = "dbscan"

    def __init__(
        self, assignments: DataFrame, train: DataFrame, eps: float, min_pts: int, key: str, importances: list[float], small_bytes: int | None = None
    ):
        super().__init__(importances, {"eps": eps, "min_pts": min_pts})
        self.assignments, self.eps, self.min_pts, self.key, self.small_bytes = assignments, eps, min_pts, key, small_bytes
        self.clustered = (
            train.select(col(key), "features")
            .join(assignments.where(F.col("prediction") != fixed.DBSCAN["noise"]).select(col(key), "prediction"), key)
            .select(col(key), "features", F.col("prediction").alias("label"))
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """New rows take the cluster of the nearest clustered training row within eps, else noise."""
        noise = F.lit(fixed.DBSCAN["noise"])
        if self.clustered.isEmpty():
            return dataset.withColumn("prediction", noise.cast("int"))
        # Rows are numbered here, so that every row is returned once, whatever its key.
        numbered = checkpointed(dataset.withColumn("_scored", F.monotonically_increasing_id()))
        found = nearest_neighbors(numbered, self.clustered, 1, "_scored", self.key, "label", small_bytes=self.small_bytes)
        label = F.when(F.col("distance") <= F.lit(self.eps), F.col("neighbor_label").cast("int")).otherwise(noise)
        return numbered.join(found.select("_scored", label.alias("prediction")), "_scored", "left").drop("_scored")


def train_dbscan(
    df: DataFrame, key: str = ROW_ID, eps: float | None = None, min_pts: int | None = None, small_bytes: int | None = None, small_edges: int | None = None
) -> DbscanModel:
    eps = estimate_eps(df, key).first()["eps"] if eps is None else eps
    min_pts = minimum_points(df.count()) if min_pts is None else min_pts
    return DbscanModel(dbscan(df, eps, min_pts, key, small_edges), df, eps, min_pts, key, dispersion(df), small_bytes)
