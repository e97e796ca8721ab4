"""Shared scratch space: the folder the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Of tables that a job writes and reads again: fewer bytes than Spark's default at little more time.
COMPRESSION = "zstd"


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local run without one gets a temporary folder."""
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cardledger-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared scratch space."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, folders: str | None = None) -> DataFrame:
    """Write `df` as a table in the shared scratch space and go on from there.

    This cuts the lineage like checkpoint(), but computes `df` once, and readers take only the
    columns they need, and only the folders where the table has them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(folders) if folders else df.write
    writer.parquet(path, compression=COMPRESSION)
    return spark.read.schema(df.schema).parquet(path)
