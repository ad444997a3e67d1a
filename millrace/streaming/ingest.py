"""Change-feed ingest (ST1-ST5): each micro-batch is appended once, every version is a replay.

A batch costs what it holds: its changes are folded to one per key and written as the log partition ``epoch=<id>``.
Replaying an epoch overwrites that partition with the same rows, so it changes nothing. Any version, any moment and the
history are replays of the log by (ts_ms, epoch, offset), which also settles late changes. The current rows alone are
kept by the stream's own state, see ``keyed_state``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.errors import QueryError
from millrace.functions.grains import epoch_to_ts
from millrace.operators.changes import DELETE, change_history, flatten_change, latest_by_key
from millrace.sources.paths import exists
from millrace.streaming.keyed_state import META


@dataclass(frozen=True)
class KeyedTable:
    """A replicated table: where it lives, its key columns and its optional epoch-seconds time column."""

    path: str
    keys: Sequence[str]
    time_col: str | None = None

    @property
    def order(self) -> list[Column]:
        return [F.desc("_ts_ms"), F.desc("epoch"), F.desc("_offset")]

    def write_epoch(self, changes: DataFrame, epoch: int) -> None:
        """ST4: ``changes`` has the row columns and ``_op, _ts_ms, _offset``."""
        folded = latest_by_key(changes, self.keys, [F.desc("_ts_ms"), F.desc("_offset")])
        folded.write.mode("overwrite").parquet(f"{self.path}/log/epoch={epoch}")

    def log(self, spark: SparkSession, until: int | None = None) -> DataFrame:
        """All epochs, or those up to one; the others are not read."""
        if not exists(spark, f"{self.path}/log"):
            raise QueryError(f"no finished epoch under {self.path}")
        rows = spark.read.parquet(f"{self.path}/log").withColumn("epoch", F.col("epoch").cast("bigint"))
        return rows if until is None else rows.where(F.col("epoch") <= until)

    def state(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The table now, or as of a version: rows only, no bookkeeping columns."""
        live = latest_by_key(self.log(spark, version), self.keys, self.order).where(F.col("_op") != DELETE)
        return live.drop(*META, "epoch")

    def as_of_time(self, spark: SparkSession, ts_ms: int) -> DataFrame:
        """The table as it stood at a moment, from the retained log."""
        kept = latest_by_key(self.log(spark).where(F.col("_ts_ms") <= ts_ms), self.keys, self.order)
        return kept.where(F.col("_op") != DELETE).drop(*META, "epoch")

    def history(self, spark: SparkSession) -> DataFrame:
        """Per version its time and its inserted, updated and deleted rows."""
        return change_history(self.log(spark), self.keys, self.order, "epoch", "_ts_ms", "_op")


def to_changes(decoded: DataFrame, table: KeyedTable, offset: str = "offset") -> DataFrame:
    """Envelopes to log rows: the new row, its key filled in from the old row on a delete, date parts."""
    if offset not in decoded.columns:
        decoded = decoded.withColumn(offset, F.lit(0).cast("bigint"))
    flat = flatten_change(decoded, table.keys)
    named = {k: F.col(f"before_{k}") for k in table.keys}
    flat = flat.withColumns(named).drop(*[f"before_{k}" for k in table.keys])
    flat = flat.withColumnsRenamed({"op": "_op", "ts_ms": "_ts_ms", offset: "_offset"})
    time_col = table.time_col
    if time_col:
        moment = epoch_to_ts(time_col, "epoch_s")
        flat = flat.withColumns({"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)})
    return flat


def apply_batch(table: KeyedTable, decode: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """ST3: the ``foreachBatch`` body of one table. Errors stop the query; nothing is swallowed."""

    def body(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        decoded = decode(batch) if decode else batch
        table.write_epoch(to_changes(decoded, table), epoch)

    return body


def start_ingest(
    feeds: Mapping[str, DataFrame],
    tables: Mapping[str, KeyedTable],
    checkpoints: str,
    interval: str | None = "60 seconds",
    decoders: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> dict[str, StreamingQuery]:
    """ST1, ST2: one independent query per table with its own checkpoint folder.

    ``interval=None`` drains what is there and stops.
    """
    unknown = set(feeds) - set(tables)
    if unknown:
        raise QueryError(f"no keys declared for {sorted(unknown)}")
    started = {}
    for name, feed in feeds.items():
        writer = feed.writeStream.queryName(name).option("checkpointLocation", f"{checkpoints}/{name}")
        writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
        started[name] = writer.foreachBatch(apply_batch(tables[name], (decoders or {}).get(name))).start()
    return started


def await_all(queries: Mapping[str, StreamingQuery]) -> None:
    """Wait until all have ended; whichever fails first is raised as soon as it does."""
    waiting = list(queries.values())
    while waiting:
        # a failed query raises here; only these queries are looked at
        waiting = [q for q in waiting if not q.awaitTermination(1)]


def stream_grain_metrics(events: DataFrame, time: str, value: str, by: Sequence[str], width: str, watermark: str) -> DataFrame:
    """ST6: count and sum per window of an event stream, late data bounded by the watermark."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)
    return timed.groupBy(F.window(time, width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")
    )


