"""Lineage cuts: tables written to the cluster's shared folder and read back.

A written table outlives the executors that made it, keeps column pruning and
statistics, and pins the outcome of anything that depends on partition placement.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a row group: each writing task holds one, and wide texts need no larger ones.
ROW_GROUP = 32 << 20

_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="rentscope-")
    return _local_dir


def _own_folder(spark: SparkSession) -> str:
    """All that this application saves."""
    return f"{shared_dir(spark)}/rentscope/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_saved(spark: SparkSession) -> None:
    """Remove what this application has saved; call it once its results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the stored table; it stays until ``drop_saved``."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
