"""Row filters and samples: usable rows, preview, systematic sample, exact-size holdout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions import fixed
from tabml.functions.values import as_number, col, is_missing
from tabml.operators.ordering import dense_positions
from tabml.sources.rows import ROW_ID

# Rows sorted in one go when the holdout boundary is narrowed down.
BOUNDARY_ROWS = 10_000
_PREFIX_STEP = 4


def usable_rows(df: DataFrame, target: str | None, problem_type: str) -> DataFrame:
    """Rows whose target can be learned from; all rows without supervision."""
    if problem_type == "regression":
        return df.where(as_number(df, target).isNotNull())
    if problem_type == "classification":
        return df.where(~is_missing(df, target))
    return df


def preview(df: DataFrame, key: str = ROW_ID, rows: int = fixed.PREVIEW_ROWS) -> DataFrame:
    return df.orderBy(col(key)).limit(rows)


def systematic_sample(df: DataFrame, limit: int | None, key: str = ROW_ID, dense: bool = False) -> DataFrame:
    """Keep the rows at positions floor(i * n / limit) in key order, all rows when n <= limit.

    A row is picked by looking at its own position only: p is one of the wanted positions when the
    smallest i with i * step >= p gives floor(i * step) = p. So nothing is joined or shuffled once
    positions exist; `dense=True` says the key already holds them.
    """
    if limit is None:
        return df
    n = df.count()
    if n <= limit:
        return df
    step = n / limit
    position = "_position"
    placed = df.withColumn(position, col(key).cast("bigint")) if dense else dense_positions(df, [key], position)
    # Rounding of i * step may shift the estimate by one, so its neighbours are tried as well.
    guess = F.floor(F.col(position) / F.lit(step))
    picks = [
        (guess + shift >= 0) & (guess + shift < limit)
        & (F.floor((guess + shift).cast("double") * F.lit(step)) == F.col(position))
        for shift in (-1, 0, 1, 2)
    ]
    return placed.where(picks[0] | picks[1] | picks[2] | picks[3]).drop(position)


def key_hash(seed: int, key: str) -> Column:
    """Hexadecimal text that stands in for a random draw per key."""
    return F.md5(F.concat(F.lit(f"{seed}-"), col(key).cast("string")).cast("binary"))


def holdout(df: DataFrame, ratio: float = fixed.HOLDOUT_RATIO, seed: int = fixed.HOLDOUT_SEED, key: str = ROW_ID) -> DataFrame:
    """Add `is_test`, true for exactly max(1, floor(n * ratio)) rows.

    Rows are ranked by the hash of their unique key. Instead of sorting them all, the boundary is
    narrowed down by counting hash prefixes (at most 65,536 groups a pass); `is_test` is then a
    comparison with one literal and needs no shuffle. Depends on keys only, never on partitions.
    """
    hashes = df.select(key_hash(seed, key).alias("h"), col(key).alias("k"))
    n = hashes.count()
    if n == 0:
        return df.withColumn("is_test", F.lit(False))
    wanted = max(1, int(n * ratio))
    prefix, left = "", n
    while left > BOUNDARY_ROWS and len(prefix) < 32:
        length = len(prefix) + _PREFIX_STEP
        counts = (
            hashes.where(F.startswith(F.col("h"), F.lit(prefix)))
            .groupBy(F.substring("h", 1, length).alias("p"))
            .agg(F.count(F.lit(1)).alias("c"))
        )
        # At most 16^4 rows: one per prefix.
        window = Window.partitionBy(F.lit(0)).orderBy("p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        row = (
            counts.withColumn("upto", F.sum("c").over(window)).where(F.col("upto") >= wanted).orderBy("p").first()
        )
        wanted -= row["upto"] - row["c"]
        prefix, left = row["p"], row["c"]
    inside = hashes.where(F.startswith(F.col("h"), F.lit(prefix)))
    last = inside.orderBy("h", "k").limit(wanted).agg(F.max(F.struct("h", "k")).alias("b")).first()["b"]
    own = F.struct(key_hash(seed, key).alias("h"), col(key).alias("k"))
    return df.withColumn("is_test", own <= F.struct(F.lit(last["h"]).alias("h"), F.lit(last["k"]).cast(df.schema[key].dataType).alias("k")))


def bernoulli_holdout(df: DataFrame, ratio: float = fixed.HOLDOUT_RATIO, seed: int = fixed.HOLDOUT_SEED, key: str = ROW_ID) -> DataFrame:
    """Add `is_test` by hash threshold alone: no pass over the data, size only about n * ratio."""
    draw = F.conv(F.substring(key_hash(seed, key), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    return df.withColumn("is_test", draw < ratio)
