"""Session helpers: reading tables, cutting lineage durably, sizing shuffles."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table `name` under `root` (a file or a folder of files)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one of its own only where the session names none and all runs on this machine."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(known)
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="quarrymill-checkpoint-")
    spark.sparkContext.setCheckpointDir(made)
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def durable(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared checkpoint folder, so that a lost executor costs nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parallelism(spark: SparkSession, least: int = 1) -> int:
    """Partitions for an explicit repartition: the session's shuffle setting, not under `least`."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
