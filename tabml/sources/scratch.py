"""Shared scratch space: reliable checkpoints that survive the loss of executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    `spark.checkpoint.dir` names it on a cluster. Where it is unset, a local session, as in tests, gets
    a temporary folder that is deleted at its end; any other session is refused, as its
    executors might not see the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{context._jvm.System.getProperty('java.io.tmpdir')}/scratch-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder as Parquet and read back.

    Cuts the lineage like a checkpoint; beyond that later reads are pruned by column and the planner
    knows the true size, so it broadcasts a side of a join only if that is below the session's limit.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder and cut the lineage.

    Used where a later step must see the very same rows in the very same partitions, and between
    the rounds of iterative jobs.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    return df.checkpoint(eager=True)
