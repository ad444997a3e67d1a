"""What the operators of this subpackage share: bounded Arrow batches, settled tables, fold marks, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.paths import scratch_folder

#: Rows and bytes of one Arrow batch: what a Python worker holds at a time, however long the texts are.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20
#: Rows of a settled table of a few numbers each that may be broadcast: some 10 MB.
FEW = 200_000


def bound_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers of this session get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the cluster's shared folder: cuts lineage, survives lost executors."""
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shuffled(df: DataFrame) -> DataFrame:
    """The frame, to be joined by sorted shuffles and never broadcast: for what grows with the input.

    Spark sizes exploded rows like those before, arrays like one element and settled tables by their compressed files, so it would
    send many times its limit through the driver.
    """
    return df.hint("merge")


def shuffled_unless_few(settled: DataFrame) -> DataFrame:
    """The same for a settled table, counted: up to ``FEW`` of its rows Spark may broadcast it."""
    return settled if settled.count() <= FEW else shuffled(settled)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32(doc_id as text) mod ``folds`` is ``fold``; false for a null id."""
    mark = F.crc32(doc_id.cast("string").cast("binary")) % folds == fold
    return F.coalesce(mark, F.lit(False))


def bounded_sample(rows: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """At most ``limit`` rows: those with the smallest hash of their key (the same rows in every run)."""
    return rows.orderBy(F.xxhash64(key), key).limit(limit)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int) -> DataFrame:
    """A bounded sample (text, y) of labelled rows outside the held-out fold.

    Ids are chosen first, from the narrow label table, so that no unsampled text is moved. Rows without
    an id or a label teach nothing.
    """
    chosen = labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("double").alias("y"))
    chosen = chosen.where(F.col("__id").isNotNull() & F.col("y").isNotNull() & ~fold_of(F.col("__id"), folds, held))
    chosen = bounded_sample(chosen, limit, "__id")
    texts = docs.select(F.col("doc_id").alias("__doc"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("text", "y")
