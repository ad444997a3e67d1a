"""What a registered query is, and the table readers they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Register:
    """Collects entries: ``add(name, sql)`` decorates a function of (spark, folder)."""

    def __init__(self) -> None:
        self.entries: dict[str, Entry] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(run: Query) -> Query:
            self.entries[name] = Entry(run, sql)
            return run

        return keep


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def daily(df: DataFrame, *by: str) -> DataFrame:
    """Events folded to a day (and type): the usual series frame."""
    from millrace.functions.grains import time_bucket

    return df.groupBy(time_bucket("ts", "P1D").alias("day"), *by).agg(F.sum("value").alias("v"))


def money(c: Column | str, digits: int = 2) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)
