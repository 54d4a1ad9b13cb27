"""Scoring a stream: the batch projection applied to new files as they arrive.

Scoring keeps no state, so it needs no watermark. It works for every model whose `transform` is a
projection, that is all but DBSCAN and a nearest-neighbour model with a large training side. Those need a join: they score each
micro-batch as a table of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tabml.plans.pipeline import Trained


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).format(fmt).load(path)


def score_stream(trained: Trained, stream: DataFrame) -> DataFrame:
    return trained.score(stream)


def write_scores(scored: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append scores to files, once per input row, and stop when the waiting input is done."""
    return (
        scored.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def batch_writer(score: Callable[[DataFrame], DataFrame], path: str) -> Callable[[DataFrame, int], None]:
    """Scores of a micro-batch go to a folder named by its id and replace what is there, so a batch that is repeated after a failure is written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def write_scores_by_batch(score: Callable[[DataFrame], DataFrame], stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """For models that need a join: score the waiting input batch by batch, then stop. Read the result with its `batch` column."""
    return stream.writeStream.foreachBatch(batch_writer(score, path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
