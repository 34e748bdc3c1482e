"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job should start with.  AQE picks the number of reducers
# from the measured shuffle size, splits skewed join partitions and turns joins
# with a small measured side into broadcast joins.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Bytes a reducer should handle.
REDUCER_BYTES = 128 * 1024 * 1024


def settings_for(largest_shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Recommended settings with partition numbers for a job of a known size.

    Shuffles start with enough partitions for ``REDUCER_BYTES`` each; AQE merges
    those that turn out small, so a generous number costs little.  Large inputs
    get larger splits, which keeps the number of map tasks, and of partial results
    to merge, in bounds.
    """
    wanted = -(-largest_shuffle_bytes // REDUCER_BYTES)
    partitions = str(max(wanted, 2 * cores))
    split = 512 if largest_shuffle_bytes >= 10 * 1024 ** 4 else 128
    return {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(REDUCER_BYTES),
        "spark.sql.files.maxPartitionBytes": str(split * 1024 * 1024),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; set one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="keypanel-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute a table once, write it to the checkpoint folder and read it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write a table as Parquet into the checkpoint folder and read it from there.

    For tables that several passes read: columns are pruned and sizes are known.
    The folder goes when the session's process ends.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
    df.write.parquet(path)
    removed_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def removed_at_exit(spark: SparkSession, path: str) -> None:
    """Have a folder deleted, on whatever file system, when the driver ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
