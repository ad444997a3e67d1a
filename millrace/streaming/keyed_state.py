"""Newest change of each key, kept by the stream itself (ST4, ST5).

Spark's state store holds, for each key, the order of the newest change seen: its time and offset, nothing of the row. A
change that is newer goes out as a row (deletes as tombstones) and becomes the state; a late one loses, in its batch or any
later one. State and output are committed together with the source's progress, so a restart repeats nothing. The
output is an append-only table of winning changes; ``newest_state`` reads the rows that stand.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from millrace.operators.changes import DELETE, latest_by_key

#: How changes of a key are ordered, and the operation; no part of the row.
ORDER = ("_ts_ms", "_offset")
META = ("_op", *ORDER)
#: The state store that keyed state in Python needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestChange(StatefulProcessor):
    """Lets the newest change of a key's batch through if it is newer than the state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "ts_ms long, offset long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        place = lambda row: tuple(row[name] for name in ORDER)
        row = max(rows, key=place)
        if not self.newest.exists() or place(row) > tuple(self.newest.get()):
            self.newest.update(place(row))
            yield row

    def close(self) -> None:
        pass


def newest_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The streamed changes that are newer than all of their key before them; same columns."""
    changes.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return changes.groupBy(*keys).transformWithState(NewestChange(), changes.schema, "Append", "None")


def start_newest(changes: DataFrame, keys: Sequence[str], path: str, checkpoint: str, interval: str | None = "60 seconds") -> StreamingQuery:
    """Writes the winning changes to ``path`` as Parquet; ``interval=None`` drains what is there and stops."""
    writer = newest_changes(changes, keys).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()


def newest_state(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The rows that stand: each key's last winning change, without deleted keys and bookkeeping."""
    kept = latest_by_key(spark.read.schema(schema).parquet(path), keys, [F.desc(c) for c in ORDER])
    return kept.where(F.col("_op") != DELETE).drop(*META)
