"""Order, limits, samples and filter choices (SL1-SL9, SU1-SU3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.text import natural_key
from millrace.operators.changes import latest_by_key
from millrace.operators.scale import join_null_safe

# Limits for results handed to a client.
DEFAULT_ROW_LIMIT = 50_000
SAMPLES_LIMIT = 1_000
CLIENT_MAX_ROWS = 100_000


def sort_keys(by: Sequence[str | Column], ascending: bool | Sequence[bool] = True) -> list[Column]:
    flags = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    if len(flags) != len(by):
        raise QueryError("one direction per sort key")
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    return [k.asc_nulls_last() if up else k.desc_nulls_last() for k, up in zip(keys, flags)]


def sort_op(df: DataFrame, by: Sequence[str] | str | None, ascending: bool | Sequence[bool] = True) -> DataFrame:
    """SL5: no key leaves the frame as it is."""
    if not by:
        return df
    return df.orderBy(*sort_keys([by] if isinstance(by, str) else by, ascending))


def effective_limit(requested: int | None, default: int = DEFAULT_ROW_LIMIT, ceiling: int = CLIENT_MAX_ROWS) -> int:
    """SL2: rows handed to a client; 0 asks for the ceiling."""
    if requested is None:
        requested = default
    return min(requested, ceiling) if requested else ceiling


def page(df: DataFrame, order: Sequence[Column | str], per_page: int, page_number: int = 1) -> DataFrame:
    """SL3: one page of an ordered frame."""
    if not order:
        raise QueryError("paging needs an order")
    offset = max(0, (page_number - 1) * per_page)
    return df.orderBy(*order).offset(offset).limit(per_page)


def limit_with_flag(df: DataFrame, n: int) -> tuple[DataFrame, bool]:
    """SL4: at most ``n`` rows and whether more exist, from one bounded fetch of n + 1 rows."""
    fetched = df.limit(n + 1)
    more = fetched.count() > n
    return df.limit(n), more


def samples(df: DataFrame, limit: int = SAMPLES_LIMIT) -> DataFrame:
    """SL8: as many raw rows as asked for, as they come; a client's ceiling (``effective_limit``) is the client's."""
    return df.limit(limit)


def drill_detail(df: DataFrame, condition: Column, order: Sequence[Column | str], per_page: int, page_number: int = 1):
    """SL8: the raw rows behind a cell, one page of them, and how many there are."""
    rows = df.where(condition)
    return page(rows, order, per_page, page_number), rows.agg(F.count(F.lit(1)).alias("total"))


def distinct_values(
    df: DataFrame,
    col: str,
    n: int | None = None,
    metric: Column | None = None,
    fetch_predicate: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """SL9 and FL17: choices for a filter, in label order or by a metric; all of them unless ``n`` says how many."""
    some = (lambda rows: rows) if n is None else (lambda rows: rows.limit(n))
    if fetch_predicate:
        df = df.where(F.expr(fetch_predicate))
    if metric is None:
        return some(df.select(col).distinct().orderBy(col))
    ranked = df.groupBy(col).agg(metric.alias("metric"))
    by = F.col("metric").desc_nulls_last() if descending else F.col("metric").asc_nulls_last()
    return some(ranked.orderBy(by, col))


def order_series(
    df: DataFrame, series: Sequence[str], x: str, value: str, by: str = "sum", ascending: bool = True
) -> DataFrame:
    """SL6: rows ordered by an aggregate of their series (``series_key``), or by series name.

    The key is folded to one row per series and joined back; the final sort is Spark's
    range-partitioned one.
    """
    measures = {"sum": F.sum(value), "min": F.min(value), "max": F.max(value), "avg": F.avg(value)}
    names = [natural_key(c) for c in series]
    if by == "name":
        return df.orderBy(*[n.asc() if ascending else n.desc() for n in names], x)
    if by not in measures:
        raise QueryError(f"cannot order series by {by}")
    keyed = join_null_safe(df, df.groupBy(*series).agg(measures[by].alias("series_key")), series, "left")
    key = F.col("series_key").asc_nulls_last() if ascending else F.col("series_key").desc_nulls_last()
    return keyed.orderBy(key, *names, x)


def order_pivot(
    df: DataFrame, keys: Sequence[str], value: str, mode: str = "key_a_to_z"
) -> DataFrame:
    """SL7: rows ordered by natural key or by value, either direction."""
    natural = [natural_key(k) for k in keys]
    orders = {
        "key_a_to_z": [k.asc() for k in natural],
        "key_z_to_a": [k.desc() for k in natural],
        "value_a_to_z": [F.col(value).asc_nulls_last(), *natural],
        "value_z_to_a": [F.col(value).desc_nulls_last(), *natural],
    }
    if mode not in orders:
        raise QueryError(f"unknown pivot order: {mode}")
    return df.orderBy(*orders[mode])


def union_series(frames: Mapping[str, DataFrame], x: str, value: str) -> tuple[DataFrame, DataFrame]:
    """SU1: several charts' series in one long frame under ``prefix``, and the shared x range."""
    parts = [df.withColumn("chart", F.lit(name)) for name, df in frames.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union, union.agg(F.min(x).alias("x_min"), F.max(x).alias("x_max"))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """SU3: one row per key, chosen by a total order."""
    return latest_by_key(df, keys, order)
