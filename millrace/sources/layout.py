"""Table layout: partitioned first load, compaction, clustering (SC4, SC9, SC10)."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.grains import add_date_parts
from millrace.operators.changes import DELETE
from millrace.operators.scale import chunk_of, split_points
from millrace.sources.paths import size_bytes

DATE_PARTS = ("year", "month", "day")


@contextmanager
def _settings(spark: SparkSession, **conf: str):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_partitioned(df: DataFrame, path: str, time_col: str | None = None, op: str = "op") -> None:
    """SC4: drop deletes, add date parts, write by year/month/day when there is a time column.

    ``rebalance`` sizes the files: a crowded day is split over tasks, thin days share one.
    """
    if op in df.columns:
        df = df.where(F.col(op) != DELETE)
    if time_col is None:
        df.hint("rebalance").write.mode("overwrite").parquet(path)
        return
    dated = add_date_parts(df, time_col)
    dated.hint("rebalance", *DATE_PARTS).write.mode("overwrite").partitionBy(*DATE_PARTS).parquet(path)


def compact(
    spark: SparkSession, path: str, target: str, target_mb: int = 128, partition_by: Sequence[str] = ()
) -> None:
    """SC9: the same rows in files of about ``target_mb`` at ``target``; readers switch when it is done."""
    size = f"{target_mb}m"
    with _settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=size,
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    ):
        writer = spark.read.parquet(path).hint("rebalance", *partition_by).write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def z_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """Interleaved bits of each column's quantile rank: near rows get near keys."""
    pieces = 2**bits
    places = [chunk_of(F.col(c).cast("double"), split_points(df, c, pieces)) for c in cols]
    key = F.lit(0).cast("bigint")
    for bit in range(bits - 1, -1, -1):
        for place in places:
            key = key * 2 + F.shiftright(place, bit).bitwiseAND(F.lit(1))
    return key


def cluster_rewrite(
    spark: SparkSession, path: str, target: str, cols: Sequence[str], target_mb: int = 128, z_order: bool = False
) -> None:
    """SC10: rows laid out by columns so scans skip files and row groups."""
    df = spark.read.parquet(path)
    files = max(1, -(-size_bytes(spark, path) // (target_mb * 1024 * 1024)))
    if z_order:
        keyed = df.withColumn("__z", z_key(df, cols))
        laid = keyed.repartitionByRange(files, "__z").sortWithinPartitions("__z").drop("__z")
    else:
        laid = df.repartitionByRange(files, *cols).sortWithinPartitions(*cols)
    laid.write.mode("errorifexists").parquet(target)
