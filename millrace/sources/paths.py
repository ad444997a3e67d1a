"""Shared-storage paths through Hadoop's file system (works on any store the cluster mounts)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.session import shared_folder


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """True only if the path is there; any other trouble is raised."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the cluster's shared checkpoint folder (in the warehouse where none is set)."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame, purpose: str = "round") -> DataFrame:
    """The frame as a table in the shared folder: what each round of an iteration goes on from.

    Unlike a checkpoint it also drops the constraints Spark has derived for the columns, which grow with every round.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
