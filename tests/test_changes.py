"""Change feeds: merge equals replay under any batch split, replays change nothing, late changes lose."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import QueryError
from millrace.operators import changes
from millrace.sources import feed, files, layout, tables
from millrace.streaming import ingest, keyed_state

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("created_at", T.IntegerType())])
FEED = feed.envelope(ROW).add("offset", T.LongType())


def make_log(seed, n=60, keys=6):
    rng = random.Random(seed)
    log = []
    for i in range(n):
        key, op = rng.randrange(keys), rng.choice("cuud")
        row = {"id": key, "v": f"v{i}", "created_at": 1_500_000_000 + i}
        # equal and out-of-order times occur
        envelope = {"op": op, "ts_ms": 1000 + i // 2 - rng.choice([0, 0, 0, 5]), "before": row if op == "d" else None}
        log.append({**envelope, "after": None if op == "d" else row, "offset": i})
    return log


def truth(log):
    latest = {}
    for c in sorted(log, key=lambda c: (c["ts_ms"], c["offset"])):
        key = (c["after"] or c["before"])["id"]
        latest[key] = c
    return {k: c["after"]["v"] for k, c in latest.items() if c["op"] != "d"}


def state_of(table, spark, **options):
    return {r["id"]: r["v"] for r in table.state(spark, **options).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_under_random_splits(spark, tmp_path, seed):
    log = make_log(seed)
    rng = random.Random(seed)
    table = ingest.KeyedTable(str(tmp_path / "t"), ["id"], "created_at")
    body = ingest.apply_batch(table)
    start, epoch, parts = 0, 0, []
    while start < len(log):
        step = rng.randrange(5, 25)
        part = spark.createDataFrame(log[start : start + step], FEED)
        parts.append(part)
        body(part, epoch)
        start, epoch = start + step, epoch + 1
    assert state_of(table, spark) == truth(log)
    # a replayed epoch changes nothing
    body(parts[-1], epoch - 1)
    assert state_of(table, spark) == truth(log)
    assert set(table.state(spark).columns) == {"id", "v", "created_at", "year", "month", "day"}


def test_versions_times_and_history(spark, tmp_path):
    table = ingest.KeyedTable(str(tmp_path / "t"), ["id"])
    body = ingest.apply_batch(table)

    def change(op, key, v, ts, offset):
        row = {"id": key, "v": v, "created_at": 0}
        return {"op": op, "ts_ms": ts, "before": row if op == "d" else None, "after": None if op == "d" else row, "offset": offset}

    batches = [
        [change("c", 1, "a", 10, 0), change("c", 2, "b", 11, 1), change("c", 9, "x", 11, 2), change("d", 9, "x", 12, 3)],
        [change("u", 1, "a2", 20, 4), change("d", 2, "b", 21, 5), change("d", 77, "no", 21, 6)],
        [],
        [change("u", 1, "old", 15, 7), change("c", 3, "c", 30, 8)],
    ]
    for epoch, batch in enumerate(batches):
        body(spark.createDataFrame(batch, FEED), epoch)
    assert state_of(table, spark, version=0) == {1: "a", 2: "b"}
    assert state_of(table, spark, version=1) == {1: "a2"}
    assert state_of(table, spark) == {1: "a2", 3: "c"}
    assert {r["id"]: r["v"] for r in table.as_of_time(spark, 20).collect()} == {1: "a2", 2: "b"}
    history = {r["epoch"]: (r["inserted"], r["updated"], r["deleted"]) for r in table.history(spark).collect()}
    assert history == {0: (2, 0, 0), 1: (0, 1, 1), 3: (1, 1, 0)}
    # tombstones stay in the log, so a late change still loses
    body(spark.createDataFrame([change("u", 2, "late", 19, 9)], FEED), 4)
    assert state_of(table, spark) == {1: "a2", 3: "c"}


def test_missing_table_is_an_error(spark, tmp_path):
    with pytest.raises(QueryError):
        ingest.KeyedTable(str(tmp_path / "none"), ["id"]).state(spark)


def test_streams_one_per_table(spark, tmp_path):
    logs = {"a": make_log(7), "b": make_log(8)}
    feeds, keyed = {}, {}
    for name, log in logs.items():
        folder = tmp_path / f"feed_{name}"
        folder.mkdir()
        for i in range(0, len(log), 20):
            (folder / f"{i:04d}.json").write_text("\n".join(json.dumps(c) for c in log[i : i + 20]))
        feeds[name] = feed.read_change_feed(spark, str(folder), FEED, max_files_per_trigger=1)
        keyed[name] = ingest.KeyedTable(str(tmp_path / f"table_{name}"), ["id"], "created_at")
    ingest.await_all(ingest.start_ingest(feeds, keyed, str(tmp_path / "ckpt"), interval=None))
    for name, log in logs.items():
        assert state_of(keyed[name], spark) == truth(log)
    with pytest.raises(QueryError):
        ingest.start_ingest({"c": feeds["a"]}, keyed, str(tmp_path / "ckpt"))


def test_composite_key_and_merge(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, None, "b"), (2, 1, "c")], "k1 int, k2 int, v string")
    source = spark.createDataFrame([(1, 1, "A", "u"), (1, None, None, "d"), (3, 3, "new", "c"), (4, 4, None, "d")], "k1 int, k2 int, v string, _op string")
    out = sorted(tuple(r) for r in changes.merge_changes(target, source, ["k1", "k2"]).collect())
    assert out == [(1, 1, "A"), (2, 1, "c"), (3, 3, "new")]


def test_latest_by_key_needs_an_order(spark):
    with pytest.raises(QueryError):
        changes.latest_by_key(spark.range(3), ["id"], [])


def test_wire_records(spark):
    body = json.dumps({"op": "c", "ts_ms": 5, "after": {"id": 1, "v": "x", "created_at": 0}}).encode()
    wire = spark.createDataFrame([(bytearray(b"\x00" + (258).to_bytes(4, "big") + body),)], "value binary")
    split = feed.split_wire_header(wire)
    assert split.select("schema_id").first()[0] == 258
    assert feed.decode_envelope(split.drop("value"), {258: ROW}).select("after.v").first()[0] == "x"
    with pytest.raises(Exception, match="unknown schema id"):
        feed.decode_envelope(split.drop("value"), {1: ROW}).collect()


def test_layout(spark, tmp_path):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("k"), (F.col("id") * 37 % 1000).alias("v"))
    df.repartition(20).write.parquet(str(tmp_path / "many"))
    layout.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"))
    layout.cluster_rewrite(spark, str(tmp_path / "many"), str(tmp_path / "laid"), ["k", "v"], z_order=True)
    layout.cluster_rewrite(spark, str(tmp_path / "many"), str(tmp_path / "ranged"), ["k"])
    for name in ("few", "laid", "ranged"):
        again = spark.read.parquet(str(tmp_path / name))
        assert again.exceptAll(df).isEmpty() and df.exceptAll(again).isEmpty()
    assert len(list((tmp_path / "few").glob("*.parquet"))) < len(list((tmp_path / "many").glob("*.parquet")))


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("report of today\nid;name;name;when\n1;x;y;2020-01-02\n\n2;none;z;bad\n")
    out = files.load_csv(spark, str(tmp_path / "a.csv"), sep=";", skip_rows=1, null_values=["none"], dates=["when"], types={"id": "BIGINT"})
    assert out.columns == ["id", "name", "name.1", "when"]
    rows = sorted(tuple(r) for r in out.collect())
    assert rows[0][:3] == (1, "x", "y") and rows[1] == (2, None, "z", None) and rows[0][3].year == 2020
    few = files.load_csv(spark, str(tmp_path / "a.csv"), sep=";", skip_rows=1, max_rows=1, columns=["id"])
    assert few.columns == ["id"] and few.count() == 1
    with pytest.raises(QueryError):
        files.load_csv(spark, str(tmp_path / "a.csv"), types={"id": "BLOB"})
    risky = spark.createDataFrame([("=x",)], "`@h` string")
    assert files.csv_safe(risky).columns == ["'@h"]


def test_tables(spark):
    df = spark.range(3)
    tables.create_table_as(df, "three_rows", overwrite=True, kind="VIEW")
    assert spark.table("three_rows").count() == 3
    with pytest.raises(Exception):
        tables.create_table_as(df, "three_rows", kind="VIEW")
    with pytest.raises(QueryError):
        tables.save_table(df, "x", "merge")
    with pytest.raises(QueryError):
        tables.create_table_as(df, "x", kind="INDEX")


def test_csv_keeps_a_row_that_repeats_the_header(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("made by hand\nid,name\n1,x\nid,name\n")
    out = files.load_csv(spark, str(tmp_path), skip_rows=1)
    assert sorted(tuple(r) for r in out.collect()) == [("1", "x"), ("1", "x"), ("id", "name"), ("id", "name")]


def test_state_of_the_stream(spark, tmp_path):
    """Late changes lose in their batch and across batches; a restart goes on from the state."""
    log = make_log(21, n=120)
    table = ingest.KeyedTable(str(tmp_path / "t"), ["id"])
    folder = tmp_path / "feed"
    folder.mkdir()
    for stop in (60, 120):  # the second round restarts the query on new files
        for i in range(stop - 60, stop, 20):
            (folder / f"{i:04d}.json").write_text("\n".join(json.dumps(c) for c in log[i : i + 20]))
        changed = ingest.to_changes(feed.read_change_feed(spark, str(folder), FEED, max_files_per_trigger=1), table)
        started = keyed_state.start_newest(changed, ["id"], str(tmp_path / "out"), str(tmp_path / "check"), interval=None)
        ingest.await_all({"t": started})
        rows = keyed_state.newest_state(spark, str(tmp_path / "out"), changed.schema, ["id"]).collect()
        assert {r["id"]: r["v"] for r in rows} == truth(log[:stop])
    written = spark.read.schema(changed.schema).parquet(str(tmp_path / "out")).select("id", "_ts_ms", "_offset")
    assert written.count() == written.distinct().count()


def test_saved_tables(spark, tmp_path):
    df = spark.range(4)
    tables.save_table(df, "saved_numbers", path=str(tmp_path / "numbers"))
    with pytest.raises(Exception):
        tables.save_table(df, "saved_numbers", path=str(tmp_path / "numbers"))
    tables.create_table_as(spark.range(2), "saved_numbers", overwrite=True, path=str(tmp_path / "numbers"))
    assert spark.table("saved_numbers").count() == 2
    spark.sql("DROP TABLE saved_numbers")


def test_a_failing_stream_is_reported(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(make_log(1)[0]))
    stream = feed.read_change_feed(spark, str(folder), FEED)

    def broken(batch):
        raise RuntimeError("cannot decode")

    table = ingest.KeyedTable(str(tmp_path / "t"), ["id"])
    started = ingest.start_ingest({"x": stream}, {"x": table}, str(tmp_path / "c"), interval=None, decoders={"x": broken})
    with pytest.raises(Exception, match="cannot decode"):
        ingest.await_all(started)
