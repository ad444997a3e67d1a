"""Queries that go through files and tables: write, rewrite, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.grains import ntz, truncate
from millrace.plans.base import Register, table
from millrace.sources import feed, files, layout, tables
from millrace.sources.paths import scratch_folder

R = Register()
ENTRIES = R.entries


@R.add("scan_customers", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_customers(spark, folder):
    return tables.read_table(spark, f"{folder}/customer.parquet")


@R.add(
    "registered_tables",
    "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
)
def registered_tables(spark, folder):
    tables.register_tables(spark, {f"stored_{n}": f"{folder}/{n}.parquet" for n in ("nation", "region")})
    return spark.sql("SELECT r_name, count(*) AS nations FROM stored_nation JOIN stored_region ON n_regionkey = r_regionkey GROUP BY r_name")


@R.add("view_as_select", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def view_as_select(spark, folder):
    grouped = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    tables.create_table_as(grouped, "orders_by_status", overwrite=True, kind="VIEW")
    return spark.table("orders_by_status")


@R.add(
    "partitioned_first_load",
    """SELECT o_orderkey, o_orderstatus, year(o_orderdate) AS year, month(o_orderdate) AS month, CAST(1 AS BIGINT) AS day FROM orders
       WHERE o_orderstatus <> 'P'""",
)
def partitioned_first_load(spark, folder):
    """SC4: deletes dropped, laid out by year, month and day (month starts here), read back."""
    base = scratch_folder(spark, "load")
    seconds = F.timestamp_diff("SECOND", ntz(F.lit("1970-01-01")), truncate("month", "o_orderdate"))
    op = F.when(F.col("o_orderstatus") == "P", "d").otherwise("c").alias("op")
    changes = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", op, seconds.cast("int").alias("created_at"))
    layout.write_partitioned(changes, base, "created_at")
    loaded = spark.read.parquet(base)
    return loaded.select("o_orderkey", "o_orderstatus", *[F.col(c).cast("bigint").alias(c) for c in layout.DATE_PARTS])


@R.add("compacted_copy", "SELECT count(*) AS n, round(sum(value), 2) AS total FROM events")
def compacted_copy(spark, folder):
    base = scratch_folder(spark, "compact")
    table(spark, folder, "events").repartition(16, "event_id").write.parquet(f"{base}/many")
    layout.compact(spark, f"{base}/many", f"{base}/few")
    return spark.read.parquet(f"{base}/few").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@R.add("clustered_copy", "SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 10 AND 12 AND p_retailprice < 1000")
def clustered_copy(spark, folder):
    base = scratch_folder(spark, "cluster")
    layout.cluster_rewrite(spark, f"{folder}/part.parquet", base, ["p_size", "p_retailprice"], z_order=True)
    return spark.read.parquet(base).where("p_size BETWEEN 10 AND 12 AND p_retailprice < 1000").select("p_partkey", "p_size")


@R.add(
    "csv_round_trip",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '''=' || c_name ELSE c_name END AS c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def csv_round_trip(spark, folder):
    base = scratch_folder(spark, "csv")
    key = F.col("c_custkey")
    out = table(spark, folder, "customer").select(
        "c_custkey", F.when(key % 10 == 0, F.concat(F.lit("="), F.col("c_name"))).otherwise(F.col("c_name")).alias("c_name"),
        F.when(F.col("c_acctbal") < 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
    )
    files.export_csv(out, base)
    return files.load_csv(spark, base, null_values=["n/a"], types={"c_custkey": "BIGINT", "c_acctbal": "DOUBLE"})


@R.add(
    "csv_nested_cells",
    '''SELECT c_custkey AS key, CASE c_custkey % 6 WHEN 0 THEN c_name || ', ' || c_mktsegment WHEN 1 THEN 'a "' || c_name || '" b'
         WHEN 2 THEN c_name || chr(10) || chr(10) || c_mktsegment || ',"' || chr(10) WHEN 3 THEN '' WHEN 4 THEN NULL ELSE '"' END AS cell, c_mktsegment AS last FROM customer''',
)
def csv_nested_cells(spark, folder):
    """Separators, quotes, line breaks, empty and missing text in cells and headers come back as they went out."""
    base, kind = scratch_folder(spark, "csv"), F.col("c_custkey") % 6
    name, segment, line = F.col("c_name"), F.col("c_mktsegment"), F.lit("\n")
    cell = (
        F.when(kind == 0, F.concat(name, F.lit(", "), segment)).when(kind == 1, F.concat(F.lit('a "'), name, F.lit('" b')))
        .when(kind == 2, F.concat(name, line, line, segment, F.lit(',"'), line)).when(kind == 3, F.lit(""))
        .when(kind == 4, F.lit(None).cast("string")).otherwise(F.lit('"'))
    )
    out = table(spark, folder, "customer").select(F.col("c_custkey").alias('total, "key"'), cell.alias("two\nlines"), segment.alias("last"))
    files.export_csv(out, base)
    back = files.load_csv(spark, base, types={'total, "key"': "BIGINT"})
    return back.select(F.col('`total, "key"`').alias("key"), F.col("`two\nlines`").alias("cell"), "last")


@R.add(
    "csv_safe_cells",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN '''=1+' || event_type WHEN 1 THEN '-1.5' WHEN 2 THEN '''@' || event_type || '\\|x' ELSE event_type END AS cell FROM events""",
)
def csv_safe_cells(spark, folder):
    kind = F.col("event_id") % 4
    cell = (
        F.when(kind == 0, F.concat(F.lit("=1+"), "event_type")).when(kind == 1, F.lit("-1.5"))
        .when(kind == 2, F.concat(F.lit("@"), "event_type", F.lit("|x"))).otherwise(F.col("event_type"))
    )
    return files.csv_safe(table(spark, folder, "events").select("event_id", cell.alias("cell")))


@R.add("columnar_files", "SELECT r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def columnar_files(spark, folder):
    base = scratch_folder(spark, "columnar")
    for part, name, key, label in (("a", "region", "r_regionkey", "r_name"), ("b", "nation", "n_nationkey", "n_name")):
        table(spark, folder, name).select(F.col(key).alias("key"), F.col(label).alias("name"), F.lit(1).alias("extra")).write.parquet(f"{base}/{part}")
    return files.load_columnar(spark, [f"{base}/a", f"{base}/b"], ["key", "name"])


@R.add(
    "clean_distinct_values",
    "SELECT DISTINCT c_mktsegment AS label FROM customer WHERE c_acctbal > 0 UNION SELECT DISTINCT p_type FROM part",
)
def clean_distinct_values(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_mktsegment").alias("label"), F.when(F.col("c_acctbal") > 0, 1).alias("ok"))
    kinds = table(spark, folder, "part").select(F.col("p_type").alias("label"), F.lit(1).alias("ok"))
    return files.concat_clean([customers, kinds], "label")


@R.add(
    "wire_header",
    "SELECT event_id, CAST(1 + event_id % 3 AS INTEGER) AS schema_id, props AS payload FROM events",
)
def wire_header(spark, folder):
    """SC2: marker byte, big-endian schema id, payload."""
    number = F.unhex(F.lpad(F.hex(1 + F.col("event_id") % 3), 8, "0"))
    packed = F.concat(F.unhex(F.lit("00")), number, F.col("props").cast("binary"))
    split = feed.split_wire_header(table(spark, folder, "events").select("event_id", packed.alias("value")))
    return split.select("event_id", "schema_id", F.col("payload").cast("string").alias("payload"))


@R.add(
    "decoded_envelopes",
    """SELECT event_id, 'u' AS op, CAST(event_id AS BIGINT) AS ts_ms, user_id AS id, CASE WHEN event_id % 2 = 1 THEN event_type END AS note FROM events""",
)
def decoded_envelopes(spark, folder):
    """SC3: two row versions in one batch, each read by its own schema id."""
    from pyspark.sql import types as T

    old = T.StructType([T.StructField("id", T.LongType())])
    new = T.StructType([T.StructField("id", T.LongType()), T.StructField("note", T.StringType())])
    events = table(spark, folder, "events")
    body = F.to_json(
        F.struct(
            F.lit("u").alias("op"), F.col("event_id").alias("ts_ms"),
            F.struct(F.col("user_id").alias("id"), F.when(F.col("event_id") % 2 == 1, F.col("event_type")).alias("note")).alias("after"),
        )
    )
    wire = events.select("event_id", (1 + F.col("event_id") % 2).cast("int").alias("schema_id"), body.alias("payload"))
    return feed.decode_envelope(wire, {1: old, 2: new}).select("event_id", "op", "ts_ms", "after.id", "after.note")
