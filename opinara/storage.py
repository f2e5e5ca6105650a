"""Shared work folder and staged tables.

A staged table cuts lineage at a written Parquet folder, so a lost executor re-reads files instead of recomputing the
plan. The folder is the one the cluster names in ``spark.checkpoint.dir``; only a local master may fall back to a
temporary folder of its own.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="opinara-")


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path below the work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_staged(df: DataFrame, name: str) -> str:
    """Write ``df`` below the work folder; returns the path."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of the written files."""
    return df.sparkSession.read.schema(df.schema).parquet(write_staged(df, name))


def spread(df: DataFrame) -> DataFrame:
    """Fan out a scan that has fewer splits than the cluster has cores, before heavy per-row work.

    A large input already has more splits than cores and passes through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
