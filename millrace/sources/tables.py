"""Tables by path or name (SC5, SC6, SC13, SC14, SC16)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import QueryError


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """SC6."""
    return spark.read.parquet(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append", writers: int = 8
) -> None:
    """SC5: ``writers`` bounds the connections the database sees (needs its driver jar)."""
    df.repartition(writers).write.jdbc(url, table, mode=mode, properties=dict(properties))


def save_table(df: DataFrame, name: str, if_exists: str = "fail", path: str | None = None) -> None:
    """SC13: a catalogue table, at ``path`` when given."""
    modes = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
    if if_exists not in modes:
        raise QueryError(f"unknown if_exists: {if_exists}")
    writer = df.write.mode(modes[if_exists])
    (writer.option("path", path) if path else writer).saveAsTable(name)


def create_table_as(
    df: DataFrame, name: str, overwrite: bool = False, kind: str = "TABLE", path: str | None = None
) -> None:
    """SC14: the result of a query as a table or a view."""
    if kind == "VIEW":
        df.createOrReplaceTempView(name) if overwrite else df.createTempView(name)
    elif kind == "TABLE":
        save_table(df, name, "replace" if overwrite else "fail", path)
    else:
        raise QueryError(f"cannot create a {kind}")


def register_tables(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """SC16: stored tables under names that SQL can join."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
