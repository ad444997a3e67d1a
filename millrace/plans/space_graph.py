"""Queries over points derived from keys and over trade between nations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import geo, graph, joins
from millrace.operators.steps import apply_step
from millrace.plans.base import Entry, Register, rounded, table
from millrace.plans.core import trade

R = Register()
ENTRIES = R.entries

_LON = "((o_custkey * 7919) % 36000) / 100.0 - 180"
_LAT = "((o_custkey * 104729) % 17000) / 100.0 - 85"
_POINTS = f"pts AS (SELECT o_orderkey, CAST({_LON} AS DOUBLE) AS lon, CAST({_LAT} AS DOUBLE) AS lat, o_totalprice AS w FROM orders)"


def places(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", F.expr(f"CAST({_LON} AS DOUBLE)").alias("lon"), F.expr(f"CAST({_LAT} AS DOUBLE)").alias("lat"),
        F.col("o_totalprice").alias("w"),
    )


GRID_SQL = {
    "sum": "sum(w)", "min": "min(w)", "max": "max(w)", "mean": "avg(w)", "median": "median(w)", "count": "CAST(count(w) AS DOUBLE)",
    "variance": "var_samp(w)", "deviation": "stddev_samp(w)", "p1": "quantile_cont(w, 0.01)", "p5": "quantile_cont(w, 0.05)",
    "p95": "quantile_cont(w, 0.95)", "p99": "quantile_cont(w, 0.99)",
}
_VALUE_DIGITS = {"variance": 0, "mean": 6}


def _grid_entry(agg: str, expression: str) -> Entry:
    digits = _VALUE_DIGITS.get(agg, 4)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(geo.geo_grid(places(spark, folder), "lat", "lon", 15.0, agg, "w"), digits, "value")

    return Entry(
        run,
        f"""WITH {_POINTS} SELECT CAST(floor(lon / 15) AS BIGINT) AS cell_x, CAST(floor(lat / 15) AS BIGINT) AS cell_y,
            round({expression}, {digits}) AS value FROM pts GROUP BY 1, 2""",
    )


for _agg, _expression in GRID_SQL.items():
    ENTRIES[f"geo_grid_{_agg}"] = _grid_entry(_agg, _expression)


@R.add(
    "geo_hexagons",
    f"""WITH {_POINTS}, a AS (SELECT w, (lon * (sqrt(3) / 3) - lat / 3) / 10 AS q, (lat * (2.0::DOUBLE / 3)) / 10 AS r FROM pts),
        b AS (SELECT w, q, r, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM a),
        c AS (SELECT w, rq, rr, rs, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM b)
        SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS hex_q,
          CAST(CASE WHEN dr >= dq AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS hex_r, round(sum(w), 2) AS value FROM c GROUP BY 1, 2""",
)
def geo_hexagons(spark, folder):
    cells = rounded(geo.hex_bin(places(spark, folder), "lat", "lon", 10.0, "sum", "w"), 2, "value")
    return cells.withColumns({"hex_q": F.col("hex_q").cast("bigint"), "hex_r": F.col("hex_r").cast("bigint")})


@R.add(
    "geo_geohash_cells",
    f"""WITH {_POINTS}, k AS (SELECT CAST(floor((lon + 180) / 360 * 1024) AS BIGINT) AS x, CAST(floor((lat + 90) / 180 * 1024) AS BIGINT) AS y, w FROM pts),
        m AS (SELECT x, y, count(*) AS n, list_sum(list_transform(range(10), lambda i: ((x >> CAST(i AS INTEGER)) & 1) << CAST(2 * i + 1 AS INTEGER)))
          + list_sum(list_transform(range(10), lambda i: ((y >> CAST(i AS INTEGER)) & 1) << CAST(2 * i AS INTEGER))) AS z FROM k GROUP BY 1, 2)
        SELECT x AS cell_x, y AS cell_y, CAST(n AS DOUBLE) AS value,
          substr('{geo.BASE32}', CAST(((CAST(z AS BIGINT) >> 15) & 31) + 1 AS BIGINT), 1) || substr('{geo.BASE32}', CAST(((CAST(z AS BIGINT) >> 10) & 31) + 1 AS BIGINT), 1)
          || substr('{geo.BASE32}', CAST(((CAST(z AS BIGINT) >> 5) & 31) + 1 AS BIGINT), 1) || substr('{geo.BASE32}', CAST((CAST(z AS BIGINT) & 31) + 1 AS BIGINT), 1) AS geohash FROM m""",
)
def geo_geohash_cells(spark, folder):
    return rounded(geo.geohash_grid(places(spark, folder), "lat", "lon", 4, "count", "w"), 0, "value")


@R.add(
    "geo_geohash_decoded",
    f"""WITH {_POINTS}, k AS (SELECT o_orderkey, floor((lon + 180) / 360 * 32768) AS x, floor((lat + 90) / 180 * 32768) AS y FROM pts)
        SELECT o_orderkey, round((x + 0.5) / 32768 * 360 - 180, 6) AS longitude, round((y + 0.5) / 32768 * 180 - 90, 6) AS latitude FROM k""",
)
def geo_geohash_decoded(spark, folder):
    coded = places(spark, folder).select("o_orderkey", geo.geohash_encode(F.col("lat"), F.col("lon"), 6).alias("geohash"))
    return rounded(geo.from_geohash(coded, "geohash", 6), 6, "longitude", "latitude").select("o_orderkey", "longitude", "latitude")


@R.add(
    "geo_geohash_steps",
    f"""WITH {_POINTS}, k AS (SELECT o_orderkey, floor((lon + 180) / 360 * 32768) AS x, floor((lat + 90) / 180 * 32768) AS y FROM pts)
        SELECT o_orderkey, round((x + 0.5) / 32768 * 360 - 180, 6) AS longitude, round((y + 0.5) / 32768 * 180 - 90, 6) AS latitude FROM k""",
)
def geo_geohash_steps(spark, folder):
    """There and back by named steps, with a name that needs escaping in between."""
    rows = places(spark, folder).withColumnRenamed("o_orderkey", "key, of order")
    for name, options in (
        ("geohash_encode", {"latitude": "lat", "longitude": "lon", "geohash": "code", "precision": 6}), ("escape_names", {}),
        ("geohash_decode", {"geohash": "code", "precision": 6}), ("unescape_names", {}),
    ):
        rows = apply_step(rows, name, options)
    back = rows.withColumnRenamed("key, of order", "o_orderkey")
    return rounded(back, 6, "longitude", "latitude").select("o_orderkey", "longitude", "latitude")



@R.add(
    "geo_clusters",
    f"""WITH {_POINTS} SELECT CAST(floor(lon / 30) AS BIGINT) AS cell_x, CAST(floor(lat / 30) AS BIGINT) AS cell_y, count(w) AS count,
        round(sum(w), 2) AS sum, min(w) AS min, max(w) AS max, round(avg(w), 2) AS mean, round(var_pop(w), 2) / 1e6 AS variance, round(stddev_pop(w), 2) AS deviation FROM pts GROUP BY 1, 2""",
)
def geo_clusters(spark, folder):
    cells = geo.cluster_stats(places(spark, folder), "lat", "lon", 30.0, "w")
    return cells.withColumn("variance", F.col("variance") / 1e6)


@R.add("geo_bounds", f"WITH {_POINTS} SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM pts")
def geo_bounds(spark, folder):
    return geo.bounds(places(spark, folder), "lon", "lat")


# ---- graph -------------------------------------------------------------------------------

_TRADE = """trade AS (SELECT s.n_name AS source, c.n_name AS target, l_extendedprice AS value FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation s ON s_nationkey = s.n_nationkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation c ON c_nationkey = c.n_nationkey)"""


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines from the supplier's nation to the buyer's, folded per pair before the names are looked up."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    heads = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    owners = heads.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    sold = lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_suppkey", "c_nationkey")
    joined = sold.agg(F.sum("l_extendedprice").alias("v")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    pairs = joined.groupBy("s_nationkey", "c_nationkey").agg(F.sum("v").alias("value"))
    nation = table(spark, folder, "nation")
    source = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("source"))
    target = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("target"))
    return pairs.join(source, "s_nationkey").join(target, "c_nationkey").select("source", "target", "value")


@R.add("nation_flow_links", f"WITH {_TRADE} SELECT source, target, round(sum(value), 2) AS value FROM trade GROUP BY 1, 2")
def nation_flow_links(spark, folder):
    return rounded(graph.sankey_links(flows(spark, folder), "source", "target", "value", allow_loops=True), 2, "value")


@R.add(
    "region_flow_acyclic",
    """SELECT 'from ' || n_name AS source, c_mktsegment AS target, count(*) AS value FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 UNION ALL SELECT c_mktsegment, o_orderstatus, count(*) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def region_flow_acyclic(spark, folder):
    heads = table(spark, folder, "orders").select("o_custkey", "o_orderstatus")
    buyers = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    both = heads.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    hops = F.array(
        F.struct(F.concat(F.lit("from "), F.col("n_name")).alias("source"), F.col("c_mktsegment").alias("target")),
        F.struct(F.col("c_mktsegment").alias("source"), F.col("o_orderstatus").alias("target")),
    )
    edges = both.select(F.explode(hops).alias("h")).groupBy("h.source", "h.target").agg(F.count(F.lit(1)).alias("value"))
    return graph.sankey_links(edges, "source", "target", "value")


@R.add(
    "nation_flow_cycles",
    f"""WITH {_TRADE}, e AS (SELECT DISTINCT source, target FROM trade)
        SELECT source, target FROM e WHERE source IN (SELECT target FROM e) AND target IN (SELECT source FROM e)""",
)
def nation_flow_cycles(spark, folder):
    """Links on or between cycles: nations trade both ways; regions lead in and leaves lead out."""
    edges = flows(spark, folder).select("source", "target")
    leads = table(spark, folder, "nation").select(F.col("n_regionkey").cast("string").alias("source"), F.col("n_name").alias("target"))
    leaves = edges.select("source", F.concat(F.lit("end of "), F.col("target")).alias("target"))
    return graph.cyclic_links(edges.unionByName(leads).unionByName(leaves))


NATIONS = [f"NATION_{i}" for i in range(25)]


@R.add(
    "nation_flow_matrix",
    f"WITH {_TRADE} SELECT n_name AS source, "
    + ", ".join(f"""round(coalesce(sum(value) FILTER (WHERE target = '{n}'), 0), 2) AS "{n}" """ for n in NATIONS)
    + " FROM nation LEFT JOIN trade ON source = n_name GROUP BY 1",
)
def nation_flow_matrix(spark, folder):
    names = table(spark, folder, "nation").select(F.col("n_name").alias("source"), F.col("n_name").alias("target"), F.lit(0.0).alias("value"))
    matrix = graph.dense_matrix(flows(spark, folder).unionByName(names), "source", "target", "value", NATIONS)
    return rounded(matrix, 2, *[c for c in matrix.columns if c != "source"])


@R.add(
    "nation_node_totals",
    f"""WITH {_TRADE}, b AS (SELECT source AS node, value, 'from' AS c FROM trade UNION ALL SELECT target, value, 'to' FROM trade)
        SELECT node, round(sum(value), 2) AS value, min(c) AS category FROM b GROUP BY 1""",
)
def nation_node_totals(spark, folder):
    edges = flows(spark, folder).withColumns({"f": F.lit("from"), "t": F.lit("to")})
    return rounded(graph.node_totals(edges, "source", "target", "value", "f", "t"), 2, "value")


_FAMILY = """f AS (SELECT 'world' AS id, CAST(NULL AS VARCHAR) AS parent, 0.0::DOUBLE AS value UNION ALL SELECT r_name, 'world', 1 FROM region
  UNION ALL SELECT n_name, r_name, (SELECT round(coalesce(sum(c_acctbal), 0), 2) FROM customer WHERE c_nationkey = n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@R.add(
    "nation_hierarchy",
    f"""WITH RECURSIVE {_FAMILY}, t AS (SELECT id, parent, value, 0 AS depth, id AS path FROM f WHERE id = 'world'
          UNION ALL SELECT f.id, f.parent, f.value, t.depth + 1, t.path || '/' || f.id FROM f JOIN t ON f.parent = t.id)
        SELECT a.id, a.parent, a.value, a.depth, a.path, round(sum(b.value), 2) AS subtree, count(*) AS nodes
        FROM t a JOIN t b ON b.path = a.path OR starts_with(b.path, a.path || '/') GROUP BY 1, 2, 3, 4, 5""",
)
def nation_hierarchy(spark, folder):
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    balance = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.round(F.sum("c_acctbal"), 2).alias("value"))
    leaves = nation.join(balance, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    family = (
        leaves.select(F.col("n_name").alias("id"), F.col("r_name").alias("parent"), F.coalesce("value", F.lit(0.0)).alias("value"))
        .unionByName(region.select(F.col("r_name").alias("id"), F.lit("world").alias("parent"), F.lit(1.0).alias("value")))
        .unionByName(region.limit(1).select(F.lit("world").alias("id"), F.lit(None).cast("string").alias("parent"), F.lit(0.0).alias("value")))
    )
    return rounded(graph.hierarchy_rollup(family, "id", "parent", "value"), 2, "subtree")


# ---- addresses ---------------------------------------------------------------------------

_CIDRS = """SELECT s_suppkey, CAST((s_suppkey * 7) % 256 AS VARCHAR) || '.' || CAST((s_suppkey * 13) % 256 AS VARCHAR) || '.' || CAST((s_suppkey * 29) % 256 AS VARCHAR)
  || '.0/' || CAST(8 + s_suppkey % 17 AS VARCHAR) AS cidr FROM {source}"""


_HELD = f"""WITH c AS ({_CIDRS.format(source='supplier')}), p AS (SELECT *, string_split(split_part(cidr, '/', 1), '.') AS o, CAST(split_part(cidr, '/', 2) AS INTEGER) AS bits FROM c),
        n AS (SELECT s_suppkey, cidr, bits, CAST(o[1] AS BIGINT) * 16777216 + CAST(o[2] AS BIGINT) * 65536 + CAST(o[3] AS BIGINT) * 256 AS a, CAST(pow(2, 32 - bits) AS BIGINT) AS size FROM p),
        g AS (SELECT s_suppkey, cidr, a - a % size AS lo, a - a % size + size - 1 AS hi FROM n),
        e AS (SELECT c_custkey, (c_custkey * 2654435761) % 4294967296 AS ip FROM customer)
        SELECT c_custkey, ip, s_suppkey, cidr FROM e JOIN g ON ip BETWEEN lo AND hi"""


def _in_networks(spark, folder, **how):
    addresses = table(spark, folder, "customer").select("c_custkey", F.expr("(c_custkey * 2654435761) % 4294967296").alias("ip"))
    table(spark, folder, "supplier").createOrReplaceTempView("supplier_networks")
    ranges = joins.networks(spark.sql(_CIDRS.format(source="supplier_networks").replace("VARCHAR", "STRING")), "cidr")
    return joins.ip_range_join(addresses, "ip", ranges, **how).select("c_custkey", "ip", "s_suppkey", "cidr")


@R.add("ip_ranges_join", _HELD)
def ip_ranges_join(spark, folder):
    return _in_networks(spark, folder)


@R.add("ip_ranges_sweep", _HELD)
def ip_ranges_sweep(spark, folder):
    """The way for many networks, on the same tables."""
    return _in_networks(spark, folder, few=0)


@R.add(
    "trade_lines_by_nation_pair",
    """SELECT s_nationkey AS s_nation, c_nationkey AS c_nation, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def trade_lines(spark, folder):
    return trade(spark, folder).groupBy("s_nation", "c_nation").agg(F.count(F.lit(1)).alias("n"))
