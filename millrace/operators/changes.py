"""Keyed change replay (WN1, J2, PR8, SC7, SC8, ST5) as batch DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.grains import moment
from millrace.errors import QueryError

DELETE = "d"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WN1: the first row per key under ``order`` (give a total order).

    ``row_number() = 1`` lets Spark keep one row per key in each map task before the shuffle,
    so a key holding a third of the log sends one row per task.
    """
    if not order:
        raise QueryError("latest_by_key needs an order")
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where(F.col("__place") == 1).drop("__place")


def flatten_change(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """PR8: ``op, ts_ms``, the new row, and ``before_<key>`` naming the row a change is about."""
    deleted = F.col("op") == DELETE
    others = [c for c in df.columns if c not in ("op", "ts_ms", "before", "after")]
    named = [
        F.when(deleted, F.col(f"before.{k}")).otherwise(F.col(f"after.{k}")).alias(f"before_{k}")
        for k in keys
    ]
    return df.select("op", "ts_ms", *others, "after.*", *named)


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = None
    for key in keys:
        same = left[key].eqNullSafe(right[f"__k_{key}"])
        condition = same if condition is None else condition & same
    return condition


def merge_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], op: str = "_op", ts: str | None = None
) -> DataFrame:
    """J2: apply one change per key to a keyed table.

    Matched delete removes, any other matched change replaces all columns, an unmatched delete is
    ignored, any other unmatched change inserts. With ``ts`` (ST5) a change older than the stored
    row loses; both sides then carry that column.
    """
    fresh = without_stale(target, source, keys, ts) if ts else source
    untouched = without_keys(target, fresh, keys)
    return untouched.unionByName(fresh.where(F.col(op) != DELETE).select(*target.columns))


def without_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``.

    The change side is the build side: while it is small the target is filtered where it lies.
    """
    named = source.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    return target.join(named, _same_key(target, named, keys), "left_anti")


def without_stale(target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows of ``source`` that are not older than the stored row of their key."""
    named = source.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(ts).alias("__ts"))
    newer = _same_key(target, named, keys) & (target[ts] > named["__ts"])
    # stored rows that win: at most one per change, so the second join is small on both sides
    return without_keys(source, target.join(named, newer, "left_semi").select(*keys), keys)


def replay(
    changes: DataFrame, keys: Sequence[str], order: Sequence[Column], op: str = "_op"
) -> DataFrame:
    """Current state: the latest change of each key, deletes dropped."""
    return latest_by_key(changes, keys, order).where(F.col(op) != DELETE)


def as_of_version(
    changes: DataFrame, keys: Sequence[str], epoch: int, order: Sequence[Column], epoch_col: str = "_epoch", op: str = "_op"
) -> DataFrame:
    """SC7: the table as it stood after ``epoch``; the epoch filter prunes log partitions."""
    return replay(changes.where(F.col(epoch_col) <= F.lit(epoch)), keys, order, op)


def as_of_time(
    changes: DataFrame, keys: Sequence[str], at: datetime, order: Sequence[Column], time_col: str, op: str = "_op"
) -> DataFrame:
    """SC7: the table as it stood at a moment."""
    return replay(changes.where(F.col(time_col) <= moment(at)), keys, order, op)


def change_history(
    changes: DataFrame, keys: Sequence[str], order: Sequence[Column], epoch_col: str = "_epoch", time_col: str = "ts", op: str = "_op"
) -> DataFrame:
    """SC8: per version its time and the rows inserted, updated and deleted.

    One change per key and version counts, judged against the key's previous version. Both
    windows run over one row per (key, version).
    """
    per_epoch = latest_by_key(changes, [*keys, epoch_col], order)
    live = F.col(op) != DELETE
    before = F.coalesce(F.lag(live).over(W.partitionBy(*keys).orderBy(epoch_col)), F.lit(False))
    judged = per_epoch.withColumns({"__before": before, "__live": live})
    return judged.groupBy(epoch_col).agg(
        F.max(time_col).alias("changed_at"),
        F.count_if(F.col("__live") & ~F.col("__before")).alias("inserted"),
        F.count_if(F.col("__live") & F.col("__before")).alias("updated"),
        F.count_if(~F.col("__live") & F.col("__before")).alias("deleted"),
    )
