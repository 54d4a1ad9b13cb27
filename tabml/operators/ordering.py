"""Running totals and ranks over a global order, without sorting everything in one task.

A window without a partition (or with a few huge ones) sends all rows to one task. Beyond
`SMALL_ROWS` rows the order is split into ranges instead: each range is summed on its own and the
totals of the ranges before it are added. Only one row per range and group is ever aggregated.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.values import col, quoted
from tabml.sources.scratch import checkpointed

SMALL_ROWS = 200_000
SKETCH_ACCURACY = 10_000
_RANGE, _BEFORE = "_range", "_before_"


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Column],
    small_rows: int | None = None,
) -> DataFrame:
    """Add, per measure, the total over all rows of the group up to and including this row.

    `order` must be unique within a group, otherwise ties are summed in any order.
    """
    limit = SMALL_ROWS if small_rows is None else small_rows
    order_columns = [col(c) for c in order]
    if df.count() <= limit:
        window = _running(group, order_columns)
        return df.select("*", *[F.sum(m).over(window).alias(name) for name, m in measures.items()])

    ranged = checkpointed(
        df.select("*", *[m.alias(name) for name, m in measures.items()])
        .repartitionByRange(*[quoted(c) for c in (*group, *order)])
        .withColumn(_RANGE, F.spark_partition_id())
    )
    keys = [*group, _RANGE]
    totals = ranged.groupBy(*[col(k) for k in keys]).agg(*[F.sum(col(m)).alias(m) for m in measures])
    earlier = _running(group, [F.col(_RANGE)]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[col(k) for k in keys], *[F.coalesce(F.sum(col(m)).over(earlier), F.lit(0)).alias(_BEFORE + m) for m in measures]
    )
    inside = _running(keys, order_columns)
    kept = [c for c in ranged.columns if c not in measures and c != _RANGE]
    local = ranged.select(
        *[col(c) for c in (*kept, _RANGE)], *[F.sum(col(m)).over(inside).alias(m) for m in measures]
    )
    joined = local.alias("l").join(
        offsets.alias("o"), [F.col(f"l.{quoted(k)}").eqNullSafe(F.col(f"o.{quoted(k)}")) for k in keys]
    )
    return joined.select(
        *[F.col(f"l.{quoted(c)}") for c in kept],
        *[(F.col(f"l.{quoted(m)}") + F.col(f"o.{quoted(_BEFORE + m)}")).alias(m) for m in measures],
    )


def _running(group, order):
    # A constant stands in for "no group": the frame is one partition either way.
    return (
        Window.partitionBy(*([col(g) for g in group] or [F.lit(0)]))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def dense_positions(df: DataFrame, order: Sequence[str], name: str, small_rows: int | None = None) -> DataFrame:
    """Add the zero-based position of each row in a unique order."""
    ranked = running_totals(df, [], order, {name: F.lit(1).cast("bigint")}, small_rows)
    return ranked.withColumn(name, col(name) - 1)


def exact_quantiles(
    df: DataFrame, numbers: Mapping[str, Column], probabilities: Sequence[float], small_rows: int | None = None
) -> DataFrame:
    """`(column, quantiles ARRAY<DOUBLE>)`: values interpolated at position (n - 1) * q, NULLs ignored.

    Up to `small_rows` rows the built-in exact aggregate is used, which holds all distinct values. A
    larger table is read three times more: mergeable sketches bracket each wanted position, the values
    below each bracket and inside it are counted, and only those inside it, a few in ten thousand, are
    ranked. Brackets that turn out not to hold their position are widened.
    """
    limit = SMALL_ROWS if small_rows is None else small_rows
    points = F.array(*[F.lit(float(p)) for p in probabilities])
    names = list(numbers)
    if df.count() <= limit:
        parts = [F.struct(F.lit(c).alias("column"), F.percentile(numbers[c], points).alias("quantiles")) for c in names]
        return df.agg(F.array(*parts).alias("q")).select(F.inline("q")).where(F.col("quantiles").isNotNull())

    margin = 2 / SKETCH_ACCURACY
    while True:
        brackets, below, holds = _brackets(df, numbers, probabilities, margin)
        if holds:
            break
        margin *= 8
    inside = [
        F.when(numbers[c].between(low, high), F.struct(F.lit(j).alias("j"), (numbers[c] + F.lit(0.0)).alias("v")))
        for j, (c, _, low, high, _) in enumerate(brackets)
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*inside))).alias("s"))
        .groupBy(F.col("s.j").alias("j"), F.col("s.v").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counted, ["j"], ["v"], {"upto": F.col("n")}, limit)
    wanted = df.sparkSession.createDataFrame(
        [(j, c, k, position, below[f"b{j}"]) for j, (c, k, _, _, position) in enumerate(brackets)],
        "j int, column string, k int, position double, below bigint",
    )
    last = F.col("below") + F.col("upto") - 1
    first = last - F.col("n") + 1
    # At most two values cover a wanted position: the one below and the one above it.
    hits = ranked.join(F.broadcast(wanted), "j").where((first <= F.ceil("position")) & (last >= F.floor("position")))
    weight = F.first(F.col("position") - F.floor("position"))
    values = hits.groupBy("column", "k").agg((F.min("v") * (1 - weight) + F.max("v") * weight).alias("v"))
    in_order = F.array_sort(F.collect_list(F.struct("k", "v")))
    return values.groupBy("column").agg(F.transform(in_order, lambda s: s["v"]).alias("quantiles"))


def _brackets(df: DataFrame, numbers: Mapping[str, Column], probabilities: Sequence[float], margin: float):
    """Per column and probability `(column, k, low, high, position)`; the counts below each; whether all hold their position."""
    edges = F.array(*[F.lit(float(min(1.0, max(0.0, p + side * margin)))) for p in probabilities for side in (-1, 1)])
    sketches = []
    for i, c in enumerate(numbers):
        sketches += [F.count(numbers[c]).alias(f"n{i}"), F.percentile_approx(numbers[c], edges, SKETCH_ACCURACY).alias(f"e{i}")]
    found = df.agg(*sketches).first()
    brackets = []
    for i, c in enumerate(numbers):
        for k, p in enumerate(probabilities):
            if found[f"n{i}"]:
                low, high = found[f"e{i}"][2 * k : 2 * k + 2]
                brackets.append((c, k, float(low), float(high), float((found[f"n{i}"] - 1) * p)))
    counts = [F.count_if(numbers[c] < low).alias(f"b{j}") for j, (c, _, low, _, _) in enumerate(brackets)]
    counts += [F.count_if(numbers[c] <= high).alias(f"u{j}") for j, (c, _, _, high, _) in enumerate(brackets)]
    below = df.agg(*counts).first() if counts else {}
    # Edges at 0 and 1 are the least and the largest value, so widening ends.
    holds = all(below[f"b{j}"] <= math.floor(b[4]) and math.ceil(b[4]) < below[f"u{j}"] for j, b in enumerate(brackets))
    return brackets, below, holds or margin >= 1
