"""Queries that treat ``events`` as a change log: key user, order (ts, event_id), ``error`` deletes, a day per version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.grains import ntz
from millrace.operators import changes
from millrace.plans.base import Register, table
from millrace.sources.paths import scratch_folder
from millrace.streaming import ingest, keyed_state

R = Register()
ENTRIES = R.entries

KEYS = ["user_id"]
_OPS = "events_log AS (SELECT *, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS _op, CAST(dayofyear(ts) AS BIGINT) AS _epoch FROM events)"
_LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {src}) WHERE rn = 1"


def order():
    return [F.desc("ts"), F.desc("event_id")]


def log(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.withColumns(
        {"_op": F.when(F.col("event_type") == "error", "d").otherwise("u"), "_epoch": F.dayofyear("ts").cast("bigint")}
    )


@R.add("cdc_state", f"WITH {_OPS}, l AS ({_LATEST.format(src='events_log')}) SELECT user_id, event_id, event_type, value FROM l WHERE _op <> 'd'")
def cdc_state(spark, folder):
    return changes.replay(log(spark, folder), KEYS, order()).select("user_id", "event_id", "event_type", "value")


@R.add(
    "cdc_state_as_of_version",
    f"WITH {_OPS}, s AS (SELECT * FROM events_log WHERE _epoch <= 10), l AS ({_LATEST.format(src='s')}) SELECT user_id, event_id, value FROM l WHERE _op <> 'd'",
)
def cdc_as_of_version(spark, folder):
    return changes.as_of_version(log(spark, folder), KEYS, 10, order()).select("user_id", "event_id", "value")


@R.add(
    "cdc_state_as_of_time",
    f"WITH {_OPS}, s AS (SELECT * FROM events_log WHERE ts <= TIMESTAMP '2024-01-05 12:00:00'), l AS ({_LATEST.format(src='s')}) SELECT user_id, event_id, value FROM l WHERE _op <> 'd'",
)
def cdc_as_of_time(spark, folder):
    moment = datetime(2024, 1, 5, 12)
    return changes.as_of_time(log(spark, folder), KEYS, moment, order(), "ts").select("user_id", "event_id", "value")


@R.add(
    "cdc_history",
    f"""WITH {_OPS}, e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, _epoch ORDER BY ts DESC, event_id DESC) AS rn FROM events_log) WHERE rn = 1),
        j AS (SELECT *, _op <> 'd' AS live, coalesce(lag(_op <> 'd') OVER (PARTITION BY user_id ORDER BY _epoch), false) AS was FROM e)
        SELECT _epoch, max(ts) AS changed_at, count(*) FILTER (WHERE live AND NOT was) AS inserted,
          count(*) FILTER (WHERE live AND was) AS updated, count(*) FILTER (WHERE NOT live AND was) AS deleted FROM j GROUP BY 1""",
)
def cdc_history(spark, folder):
    return changes.change_history(log(spark, folder), KEYS, order())


@R.add(
    "cdc_merge_one_batch",
    f"""WITH {_OPS}, a AS (SELECT * FROM events_log WHERE _epoch <= 15), t AS (SELECT user_id, event_id, value FROM ({_LATEST.format(src='a')}) WHERE _op <> 'd'),
        b AS (SELECT * FROM events_log WHERE _epoch = 16), s AS ({_LATEST.format(src='b')})
        SELECT * FROM t WHERE user_id NOT IN (SELECT user_id FROM s) UNION ALL SELECT user_id, event_id, value FROM s WHERE _op <> 'd'""",
)
def cdc_merge_one_batch(spark, folder):
    every = log(spark, folder)
    target = changes.as_of_version(every, KEYS, 15, order()).select("user_id", "event_id", "value")
    batch = changes.latest_by_key(every.where("_epoch = 16"), KEYS, order()).select("user_id", "event_id", "value", "_op")
    return changes.merge_changes(target, batch, KEYS)


@R.add(
    "cdc_merge_late_changes",
    f"""WITH {_OPS}, a AS (SELECT * FROM events_log WHERE _epoch <= 15 AND _op <> 'd'), t AS ({_LATEST.format(src='a')}),
        b AS (SELECT * FROM events_log WHERE _epoch BETWEEN 14 AND 16), s AS ({_LATEST.format(src='b')})
        SELECT coalesce(s.user_id, t.user_id) AS user_id, CASE WHEN s.user_id IS NULL OR t.ts > s.ts THEN t.event_id ELSE s.event_id END AS event_id,
          CASE WHEN s.user_id IS NULL OR t.ts > s.ts THEN t.ts ELSE s.ts END AS ts FROM t FULL JOIN s ON t.user_id = s.user_id
        WHERE NOT (s.user_id IS NOT NULL AND s._op = 'd' AND (t.ts IS NULL OR s.ts >= t.ts))""",
)
def cdc_merge_late_changes(spark, folder):
    """ST5: a change older than the stored row loses."""
    every = log(spark, folder)
    target = changes.replay(every.where("_epoch <= 15 AND _op <> 'd'"), KEYS, order()).select("user_id", "event_id", "ts")
    late = changes.latest_by_key(every.where("_epoch BETWEEN 14 AND 16"), KEYS, order())
    return changes.merge_changes(target, late.select("user_id", "event_id", "ts", "_op"), KEYS, ts="ts")


@R.add(
    "cdc_flattened",
    """SELECT CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms,
       CASE WHEN event_type <> 'error' THEN user_id END AS user_id, CASE WHEN event_type <> 'error' THEN value END AS value, user_id AS before_user_id FROM events""",
)
def cdc_flattened(spark, folder):
    return changes.flatten_change(envelopes(spark, folder).drop("offset"), KEYS)


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Events as change envelopes: an ``error`` deletes the user's row."""
    events = table(spark, folder, "events")
    row = F.struct("user_id", "value")
    deleted = F.col("event_type") == "error"
    millis = F.floor(F.timestamp_diff("MICROSECOND", ntz(F.lit("1970-01-01")), F.col("ts")) / 1000)
    return events.select(
        F.when(deleted, "d").otherwise("u").alias("op"),
        millis.alias("ts_ms"),
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        F.col("event_id").alias("offset"),
    )


_STATE_MS = """SELECT user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1 AND event_type <> 'error'"""


@R.add("cdc_streamed_state", _STATE_MS)
def cdc_streamed_state(spark, folder):
    """ST1-ST5 end to end: envelopes as files, several micro-batches, the rows that the stream's state lets stand."""
    base = scratch_folder(spark, "cdc")
    feed = envelopes(spark, folder)
    feed.repartition(4, "offset").write.parquet(f"{base}/feed")
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/feed")
    changed = ingest.to_changes(stream, ingest.KeyedTable(f"{base}/users", KEYS))
    started = keyed_state.start_newest(changed, KEYS, f"{base}/newest", f"{base}/checkpoint", interval=None)
    ingest.await_all({"users": started})
    return keyed_state.newest_state(spark, f"{base}/newest", changed.schema, KEYS).select("user_id", "value")


@R.add("cdc_replayed_log", _STATE_MS)
def cdc_replayed_log(spark, folder):
    """ST1-ST3: each micro-batch becomes an epoch of the log; its replay is the table."""
    base = scratch_folder(spark, "cdc")
    feed = envelopes(spark, folder)
    feed.repartition(4, "offset").write.parquet(f"{base}/feed")
    users = ingest.KeyedTable(f"{base}/users", KEYS)
    stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/feed")
    ingest.await_all(ingest.start_ingest({"users": stream}, {"users": users}, f"{base}/checkpoints", interval=None))
    return users.state(spark).select("user_id", "value")


@R.add(
    "stream_hourly_metrics",
    """WITH w AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2)
       SELECT * FROM w WHERE hour + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events)""",
)
def stream_hourly_metrics(spark, folder):
    """ST6: windows closed by the watermark, drained to files."""
    base = scratch_folder(spark, "hourly")
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/events.parq*")
    timed = ingest.stream_grain_metrics(stream, "ts", "value", ["event_type"], "1 hour", "2 hours")
    query = (
        timed.writeStream.format("parquet").outputMode("append").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = spark.read.schema(timed.schema).parquet(f"{base}/out")
    return closed.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))
