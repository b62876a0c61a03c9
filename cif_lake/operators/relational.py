"""Relational helpers that need more than one DataFrame call to hold at scale."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session in one process (``local``, as in tests) gets a folder of its own where none is named.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cif_lake_checkpoint_"))
    return context.getCheckpointDir()


def use_checkpoints(spark: SparkSession) -> None:
    shared_folder(spark)


def work_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared folder that the session names."""
    return f"{shared_folder(spark).rstrip('/')}/cif_lake-{spark.sparkContext.applicationId}-{os.urandom(4).hex()}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame computed once, as a Parquet table in the shared folder: what reads it several times reads its columns only."""
    folder = work_folder(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def numbered(frame: DataFrame, *order: Column | str, name: str = "rn") -> DataFrame:
    """``row_number() OVER (ORDER BY ...)`` without moving all rows to one task.

    Rows are range-partitioned and numbered within their partition; only the partition sizes are summed up in one place. The
    numbered rows are checkpointed, so both passes see the same partitions even when an executor is lost.
    """
    use_checkpoints(frame.sparkSession)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.spark_partition_id().alias("_part"), within.alias("_pos"))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_pos") + 1).drop("_part", "_pos", "_start", "_n")


def count_distinct(frame: DataFrame, column: str, *group: str, name: str = "n") -> DataFrame:
    """``count(DISTINCT column)`` in two steps, so a group of any size is reduced before it is counted."""
    pairs = frame.groupBy(*group, column).agg(F.lit(1).alias("one"))
    return pairs.groupBy(*group).agg(F.count(column).alias(name))
