"""Row identity: the order of a table is an explicit `_row_id` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.operators.ordering import dense_positions
from tabml.sources.scratch import checkpointed

ROW_ID = "_row_id"


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Add a dense `_row_id` starting at 0.

    With a unique `key` the ids follow its order. Without one they follow the input order: each
    partition is numbered on its own and shifted by the row counts of the partitions before it.
    """
    if key is not None:
        return dense_positions(df, [key], ROW_ID)
    # The high bits of the generated id hold the partition, the low 33 bits the row within it. The
    # checkpoint fixes both, so that the counts below fit the ids also after a task is run again.
    numbered = checkpointed(df.withColumn("_raw_id", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_part", F.shiftrightunsigned("_raw_id", 33))
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per input partition.
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_raw_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(offsets, "_part")
        .withColumn(ROW_ID, F.col("_offset") + position)
        .drop("_part", "_raw_id", "_offset")
    )
