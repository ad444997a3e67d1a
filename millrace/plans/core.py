"""Queries of the semantic core: grains, filters, metrics, limits, joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import grains, text
from millrace.functions.timetext import TimeText
from millrace.operators import filters, joins, ordering, project
from millrace.operators.aggregates import aggregate, stock_balance
from millrace.operators.filters import Filter, RowRule
from millrace.operators.query import (
    Dataset,
    Dimension,
    Metric,
    QuerySpec,
    grand_total,
    in_groups,
    row_count,
    run_query,
    top_series,
)
from millrace.plans.base import Entry, Register, money, rounded, table

R = Register()
ENTRIES = R.entries

NOW = datetime(1998, 6, 15, 9, 30, 10)


# ---- flagship and shop joins -------------------------------------------------------------

REVENUE_SQL = """
SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, p_brand AS brand,
       round(sum(l_extendedprice), 2) AS revenue, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
WHERE o_orderstatus = 'F' GROUP BY 1, 2"""


@R.add("revenue_by_month_brand", REVENUE_SQL)
def revenue_by_month_brand(spark: SparkSession, folder: str) -> DataFrame:
    """AG41: revenue of finished orders by month and brand; the line total is already a total."""
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    buyers = table(spark, folder, "customer").select("c_custkey")
    heads = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate")
    # brand is looked up after the lines are folded to (month, part)
    per_part = (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(grains.time_bucket("o_orderdate", "P1M").alias("month"), "l_partkey")
        .agg(F.sum("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("lines"))
    )
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    result = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("month", "brand").agg(
        F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines")
    )
    return rounded(result, 2, "revenue")


def shop(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The shop schema over the supplied tables."""
    part, orders = table(spark, folder, "part"), table(spark, folder, "orders")
    lines, customer = table(spark, folder, "lineitem"), table(spark, folder, "customer")
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    kinds = part.select("p_type").distinct()
    return {
        "products": part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("product_name"), F.col("p_retailprice").alias("price"),
            F.col("p_type").alias("category_id"), number.alias("brand_id"),
        ),
        "categories": kinds.select(F.col("p_type").alias("id"), F.col("p_type").alias("category_name")),
        "brands": part.select(number.alias("id"), F.col("p_brand").alias("brand_name")).distinct(),
        "inventory": part.select(F.col("p_partkey").alias("product_id"), F.lit(1000).alias("quantity")),
        "order_detail": lines.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("item_price"),
        ),
        "orders": orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("payment"),
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("status_id"),
            F.col("o_orderdate").alias("created_at"),
        ),
        "users": customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("username"), F.col("c_name").alias("fullname"),
            F.col("c_mktsegment").alias("address"),
        ),
        "order_status": orders.select("o_orderstatus").distinct().select(
            F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).alias("id"),
            F.concat(F.lit(" "), F.col("o_orderstatus")).alias("status_name"),
        ),
    }


@R.add(
    "shop_enriched_orders",
    """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS item_price,
       p_name AS product_name, p_type AS category_name, p_brand AS brand_name, 1000 AS stock,
       c_name AS username, 'O' AS status_name, o_orderdate AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O'""",
)
def shop_enriched_orders(spark, folder):
    return joins.enrich_orders(shop(spark, folder), 2).select(
        "order_id", "product_id", "quantity", "item_price", "product_name", "category_name", "brand_name", "stock",
        "username", "status_name", "created_at",
    )


@R.add(
    "stock_balance",
    """
SELECT p_partkey AS product_id, CAST(1000 AS DOUBLE) AS stock, coalesce(q, 0) AS ordered, 1000 - coalesce(q, 0) AS balance
FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""",
)
def stock(spark, folder):
    opening = table(spark, folder, "part").select(F.col("p_partkey").alias("product_id"), F.lit(1000.0).alias("stock"))
    return stock_balance(opening, table(spark, folder, "lineitem"), "product_id", "stock", "l_partkey", "l_quantity")


# ---- grains ------------------------------------------------------------------------------


def _bucket_sql(grain: str | None, c: str = "ts") -> str:
    if grain is None:
        return c
    if grain in grains.CALENDAR_GRAINS:
        return f"CAST(date_trunc('{grains.CALENDAR_GRAINS[grain]}', {c}) AS TIMESTAMP)"
    if grain in grains.SECOND_GRAINS:
        w = grains.SECOND_GRAINS[grain] * 1_000_000
        return f"make_timestamp((epoch_us({c}) // {w}) * {w})"
    before, after = grains.WEEK_GRAINS[grain]
    return f"CAST(date_trunc('week', {c} + INTERVAL {before} DAY) AS TIMESTAMP) + INTERVAL ({after}) DAY"


def _grain_entry(grain: str | None) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        dataset = Dataset(table(spark, folder, "events"), time_col="ts")
        spec = QuerySpec(
            dataset, is_timeseries=True, grain=grain,
            metrics=[Metric("n", aggregate="COUNT"), Metric("total", "value", "SUM")],
        )
        return rounded(run_query(spec), 4, "total")

    sql = f"SELECT {_bucket_sql(grain)} AS __timestamp, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"
    return Entry(run, sql)


GRAIN_KEYS = {
    None: "raw", "PT1S": "pt1s", "PT5S": "pt5s", "PT30S": "pt30s", "PT1M": "pt1m", "PT5M": "pt5m", "PT10M": "pt10m",
    "PT15M": "pt15m", "PT30M": "pt30m", "PT1H": "pt1h", "PT6H": "pt6h", "P1D": "p1d", "P1W": "p1w", "P1M": "p1m",
    "P3M": "p3m", "P1Y": "p1y", "1969-12-28T00:00:00Z/P1W": "week_from_sunday",
    "1969-12-29T00:00:00Z/P1W": "week_from_monday", "P1W/1970-01-03T00:00:00Z": "week_to_saturday",
    "P1W/1970-01-04T00:00:00Z": "week_to_sunday",
}
for _grain, _key in GRAIN_KEYS.items():
    ENTRIES[f"events_by_grain_{_key}"] = _grain_entry(_grain)


@R.add(
    "epoch_to_timestamp",
    """SELECT event_id, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_s,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_ms FROM events""",
)
def epoch_to_timestamp(spark, folder):
    micros = F.timestamp_diff("MICROSECOND", grains.ntz(F.lit("1970-01-01")), F.col("ts"))
    events = table(spark, folder, "events").select(
        "event_id", F.floor(micros / 1_000_000).alias("s"), F.floor(micros / 1000).alias("ms")
    )
    return events.select(
        "event_id", grains.epoch_to_ts("s", "epoch_s").alias("from_s"), grains.epoch_to_ts("ms", "epoch_ms").alias("from_ms")
    )


@R.add(
    "normalize_time",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) + INTERVAL 3 HOUR - INTERVAL 1 DAY END AS at
       FROM events""",
)
def normalize_time(spark, folder):
    shown = F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    events = table(spark, folder, "events").select("event_id", shown.alias("at"))
    return grains.normalize_time(events, "at", "dd/MM/yyyy HH:mm:ss", 3, ("day", -1))


@R.add(
    "date_parts",
    "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day FROM orders",
)
def date_parts(spark, folder):
    seconds = F.timestamp_diff("SECOND", grains.ntz(F.lit("1970-01-01")), F.col("o_orderdate"))
    orders = table(spark, folder, "orders").select("o_orderkey", seconds.cast("int").alias("created_at"))
    parts = grains.add_date_parts(orders, "created_at").drop("created_at")
    return parts.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month", "day")})


@R.add(
    "date_functions",
    """SELECT o_orderkey, o_orderdate + INTERVAL 3 MONTH AS plus_quarter, o_orderdate + INTERVAL 1 MONTH AS plus_month,
       CAST(date_trunc('quarter', o_orderdate) AS TIMESTAMP) AS quarter,
       CAST(last_day(o_orderdate) AS TIMESTAMP) AS month_end,
       CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) + INTERVAL 6 DAY AS week_end,
       CAST(make_date(year(o_orderdate), 12, 31) AS TIMESTAMP) AS year_end FROM orders""",
)
def date_functions(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        grains.date_add_units("o_orderdate", 1, "quarter").alias("plus_quarter"),
        grains.date_add_units("o_orderdate", 1, "month").alias("plus_month"),
        grains.truncate("quarter", "o_orderdate").alias("quarter"),
        grains.last_day_of("o_orderdate", "month").alias("month_end"),
        grains.last_day_of("o_orderdate", "week").alias("week_end"),
        grains.last_day_of("o_orderdate", "year").alias("year_end"),
    )


@R.add(
    "date_part_labels",
    """SELECT strftime(o_orderdate, '%Y-%m-%d') || ' ' || strftime(o_orderdate, '%b %a ') || CAST(dayofweek(o_orderdate) AS VARCHAR) AS label,
       l.b AS price_bin, count(*) AS n
       FROM orders, LATERAL (SELECT floor(o_totalprice / 50000) * 50000 AS b) l GROUP BY 1, 2""",
)
def date_part_labels(spark, folder):
    orders = table(spark, folder, "orders")
    label = grains.date_part_label("o_orderdate", "%y-%m-%d %n %w %x")
    return orders.groupBy(label.alias("label"), grains.bin_width("o_totalprice", 50000.0).alias("price_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


# ---- projections -------------------------------------------------------------------------


@R.add(
    "project_columns",
    "SELECT o_orderdate, o_orderkey, o_totalprice / 2 AS half, upper(o_orderpriority) AS prio FROM orders",
)
def project_columns(spark, folder):
    wanted = ["o_orderkey", ("half", "o_totalprice / 2"), ("prio", "upper(o_orderpriority)"), "o_orderkey", "o_orderdate"]
    return project.project(table(spark, folder, "orders"), wanted, time_col="o_orderdate")


@R.add("select_exclude_rename", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer")
def select_exclude_rename(spark, folder):
    return project.select_op(
        table(spark, folder, "customer"), ["c_custkey", "c_name", "c_acctbal"], ["c_name"],
        {"c_custkey": "id", "c_acctbal": "balance"},
    )


@R.add("rename_columns", "SELECT r_regionkey AS key, r_name AS region FROM region")
def rename_columns(spark, folder):
    return project.rename_op(table(spark, folder, "region"), {"r_regionkey": "key", "r_name": "region"})


@R.add(
    "label_by_rules",
    """SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'jewel' WHEN contains(p_name, 'bolt') THEN 'hardware'
       WHEN contains(p_name, 'widget') THEN 'gadget' ELSE 'other' END AS category,
       'designed by ' || regexp_extract(p_name, '(\\w+)', 1) AS description FROM part""",
)
def label_by_rules(spark, folder):
    rules = [("ring", "jewel"), ("bolt", "hardware"), ("widget", "gadget")]
    return table(spark, folder, "part").select(
        "p_partkey", text.label_by_rules("p_name", rules, "other").alias("category"), text.first_word("p_name").alias("description")
    )


@R.add(
    "expand_nested",
    """WITH o AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer), r AS (
       SELECT c_custkey, 0 AS p, c_name, c_nationkey, c_acctbal, c_custkey + 1 AS xs, 'a' AS ys FROM o
       UNION ALL SELECT c_custkey, 1, NULL, NULL, NULL, c_custkey + 2, 'b' FROM o
       UNION ALL SELECT NULL, 2, NULL, NULL, NULL, c_custkey + 3, NULL FROM o)
       SELECT CASE WHEN p = 0 THEN c_custkey END AS c_custkey, c_name AS "who.name", c_nationkey AS "who.nation", xs, ys FROM r""",
)
def expand_nested(spark, folder):
    key = F.col("c_custkey")
    nested = table(spark, folder, "customer").select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("who"),
        F.array(key + 1, key + 2, key + 3).alias("xs"),
        F.array(F.lit("a"), F.lit("b")).alias("ys"),
    )
    return project.expand_nested(nested)


@R.add(
    "json_properties",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CASE WHEN value > 75 THEN 'high' WHEN value > 25 THEN 'middle' ELSE 'low' END AS band FROM events""",
)
def json_properties(spark, folder):
    """JSON cells and a multi-branch calculated column."""
    parsed = F.from_json("props", "k int")
    band = F.when(F.col("value") > 75, "high").when(F.col("value") > 25, "middle").otherwise("low")
    return table(spark, folder, "events").select("event_id", parsed.k.alias("k"), band.alias("band"))


# ---- filters -----------------------------------------------------------------------------

_ORDERS = "SELECT o_orderkey, o_totalprice FROM orders WHERE "
FILTERS: dict[str, tuple[list[Filter], str]] = {
    "eq": ([Filter("o_orderstatus", "==", "F")], "o_orderstatus = 'F'"),
    "ne": ([Filter("o_orderstatus", "!=", "F")], "o_orderstatus <> 'F'"),
    "gt": ([Filter("o_totalprice", ">", "250000")], "o_totalprice > 250000"),
    "lt": ([Filter("o_totalprice", "<", 50000.5)], "o_totalprice < 50000.5"),
    "ge": ([Filter("o_orderdate", ">=", 883612800000)], "o_orderdate >= TIMESTAMP '1998-01-01'"),
    "le": ([Filter("o_custkey", "<=", "\t100\n")], "o_custkey <= 100"),
    "like": ([Filter("o_orderpriority", "LIKE", "%HIGH")], "o_orderpriority LIKE '%HIGH'"),
    "ilike": ([Filter("o_orderpriority", "ILIKE", "%urgent")], "o_orderpriority ILIKE '%urgent'"),
    "in": ([Filter("nullif(o_orderstatus, 'P')", "IN", ["F", "<NULL>"])], "o_orderstatus IN ('F', 'P')"),
    "not_in": ([Filter("nullif(o_orderstatus, 'P')", "NOT IN", ["F"])], "o_orderstatus = 'O'"),
    "is_null": ([Filter("nullif(o_orderstatus, 'P')", "IS NULL")], "o_orderstatus = 'P'"),
    "is_not_null": ([Filter("nullif(o_orderstatus, 'P')", "IS NOT NULL")], "o_orderstatus <> 'P'"),
    "is_true": ([Filter("o_totalprice > 300000", "IS TRUE")], "o_totalprice > 300000"),
    "is_false": ([Filter("o_totalprice > 300000", "IS FALSE")], "NOT o_totalprice > 300000"),
    "temporal_range": (
        [Filter("o_orderdate", "TEMPORAL_RANGE", "Last quarter")],
        "o_orderdate >= TIMESTAMP '1998-03-15' AND o_orderdate < TIMESTAMP '1998-06-15'",
    ),
    "grain": (
        [Filter("o_orderdate", "==", datetime(1997, 4, 1), grain="P3M")],
        "date_trunc('quarter', o_orderdate) = TIMESTAMP '1997-04-01'",
    ),
    "regex": ([Filter("o_orderpriority", "REGEX", "^[12]-")], "regexp_matches(o_orderpriority, '^[12]-')"),
}


def _filter_entry(conditions: list[Filter], clause: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        kept = filters.apply_filters(table(spark, folder, "orders"), conditions, TimeText(NOW))
        return kept.select("o_orderkey", "o_totalprice")

    return Entry(run, _ORDERS + clause)


for _name, (_conditions, _clause) in FILTERS.items():
    ENTRIES[f"filter_{_name}"] = _filter_entry(_conditions, _clause)


@R.add(
    "filter_where_having",
    """SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
       WHERE (o_orderstatus = 'O' OR o_totalprice > 400000) GROUP BY 1 HAVING count(*) > 4""",
)
def filter_where_having(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "orders")), columns=["o_custkey"],
        metrics=[Metric("n", aggregate="COUNT"), Metric("total", "o_totalprice", "SUM")],
        where="o_orderstatus = 'O' OR o_totalprice > 400000", having="n > 4",
    )
    return rounded(run_query(spec), 2, "total")


RULES = [
    RowRule("c_mktsegment = 'BUILDING'", frozenset({"analyst"}), "segment"),
    RowRule("c_mktsegment = 'MACHINERY'", frozenset({"analyst"}), "segment"),
    RowRule("c_acctbal > 0", frozenset({"analyst"})),
    RowRule("c_nationkey < 20", frozenset({"admin"}), None, False),
]


@R.add(
    "row_predicates_by_segment",
    """SELECT c_custkey, c_acctbal FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0 AND c_nationkey < 20""",
)
def row_predicates(spark, folder):
    bound = filters.with_row_predicates(table(spark, folder, "customer"), RULES, "analyst")
    return bound.select("c_custkey", "c_acctbal")


@R.add(
    "row_predicates_in_sql",
    """SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON n_nationkey = c_nationkey
       WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0 AND c_nationkey < 20 AND o_orderstatus <> 'P' GROUP BY 1""",
)
def row_predicates_in_sql(spark, folder):
    """FL12: the SQL text names plain tables; the views under those names are already filtered."""
    tables = {n: table(spark, folder, n) for n in ("orders", "customer", "nation")}
    rules = {"customer": RULES, "orders": [RowRule("o_orderstatus <> 'P'", frozenset({"analyst"}))]}
    filters.secured_views(tables, rules, "analyst", prefix="secured_")
    return spark.sql(
        """SELECT n_name, count(*) AS orders FROM secured_orders JOIN secured_customer ON o_custkey = c_custkey
           JOIN secured_nation ON n_nationkey = c_nationkey GROUP BY n_name"""
    )


@R.add(
    "latest_partition",
    """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
       AND month(o_orderdate) = (SELECT max(month(o_orderdate)) FROM orders
                                 WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders))""",
)
def latest_partition(spark, folder):
    orders = table(spark, folder, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    return filters.latest_partition(orders, ["year", "month"]).select("o_orderkey")


@R.add(
    "latest_partition_fixed",
    """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997
       AND month(o_orderdate) = (SELECT max(month(o_orderdate)) FROM orders WHERE year(o_orderdate) = 1997)""",
)
def latest_partition_fixed(spark, folder):
    orders = table(spark, folder, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    return filters.latest_partition(orders, ["year", "month"], year=1997).select("o_orderkey")


_ADDRESS = "(user_id * 1000003) % 4294967296"


@R.add(
    "filter_ip_in",
    f"""SELECT event_id, {_ADDRESS} AS ip FROM events
        WHERE {_ADDRESS} BETWEEN 33554432 AND 50331647 OR {_ADDRESS} BETWEEN 8388608 AND 16777215""",
)
def filter_ip_in(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.expr(_ADDRESS).alias("ip"))
    return filters.filter_ip(events, "ip", "IN", ["2.0.0.0/8", "0.128.0.0/9"])


@R.add("filter_ip_not_in", f"SELECT event_id, {_ADDRESS} AS ip FROM events WHERE NOT {_ADDRESS} BETWEEN 33554432 AND 50331647")
def filter_ip_not_in(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.expr(_ADDRESS).alias("ip"))
    return filters.filter_ip(events, "ip", "NOT IN", ["2.0.0.0/8"])


@R.add("filter_port", "SELECT event_id, user_id AS port FROM events WHERE user_id IN (80, 20, 21, 110)")
def filter_port(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.col("user_id").alias("port"))
    return filters.filter_port(events, "port", "IN", ["http", "ftp", 110])


@R.add("drop_null_points", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS lon FROM customer WHERE c_acctbal > 0")
def drop_null_points(spark, folder):
    points = table(spark, folder, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("lon"))
    return filters.drop_null_points(points, ["lon"])


@R.add(
    "filter_choices",
    "SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal > 5000 ORDER BY 1 LIMIT 10000",
)
def filter_choices(spark, folder):
    return ordering.distinct_values(table(spark, folder, "customer"), "c_mktsegment", fetch_predicate="c_acctbal > 5000")


@R.add(
    "filter_choices_by_metric",
    "SELECT o_custkey, round(sum(o_totalprice), 2) AS metric FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, 1 LIMIT 20",
)
def filter_choices_by_metric(spark, folder):
    return ordering.distinct_values(table(spark, folder, "orders"), "o_custkey", 20, money(F.sum("o_totalprice")))


# ---- metrics, grouping, limits -----------------------------------------------------------


@R.add(
    "simple_metrics",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(l_orderkey) AS lines, sum(l_quantity) AS qty,
       round(avg(l_discount), 6) AS discount, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1""",
)
def simple_metrics(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "lineitem")), columns=["l_returnflag"],
        metrics=[
            Metric("parts", "l_partkey", "COUNT_DISTINCT"), Metric("lines", "l_orderkey", "COUNT"),
            Metric("qty", "l_quantity", "SUM"), Metric("discount", "l_discount", "AVG"),
            Metric("low", "l_extendedprice", "MIN"), Metric("high", "l_extendedprice", "MAX"),
        ],
    )
    return rounded(run_query(spec), 6, "discount")


@R.add(
    "sql_metrics",
    """SELECT l_linestatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net,
       round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6) AS returned FROM lineitem GROUP BY 1""",
)
def sql_metrics(spark, folder):
    dataset = Dataset(
        table(spark, folder, "lineitem"),
        calculated={"net_price": "l_extendedprice * (1 - l_discount)"},
        metrics={
            "net": "round(sum(net_price), 2)",
            "returned": "round(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 6)",
        },
    )
    return run_query(QuerySpec(dataset, columns=["l_linestatus"], metrics=["net", "returned"]))


@R.add("group_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def group_distinct(spark, folder):
    return run_query(QuerySpec(Dataset(table(spark, folder, "orders")), columns=["o_orderstatus", "o_orderpriority"], metrics=[]))


@R.add("raw_select", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'")
def raw_select(spark, folder):
    dataset = Dataset(table(spark, folder, "orders"), time_col="o_orderdate")
    return run_query(
        QuerySpec(dataset, columns=["o_orderkey", "o_custkey"], since=datetime(1998, 1, 1), until=datetime(1998, 2, 1))
    )


@R.add(
    "order_by_hidden_metric",
    """SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 25""",
)
def order_by_hidden_metric(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "orders")), columns=["o_custkey"], metrics=[Metric("n", aggregate="COUNT")],
        orderby=[(Metric("spent", "o_totalprice", "SUM"), False), ("o_custkey", True)], row_limit=25,
    )
    return run_query(spec)


@R.add("page_of_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_of_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordering.page(orders, [F.desc("o_totalprice"), "o_orderkey"], 50, 3)


@R.add("sort_customers", "SELECT c_custkey, c_acctbal FROM customer")
def sort_customers(spark, folder):
    return ordering.sort_op(table(spark, folder, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], [False, True])


@R.add("row_count", "SELECT count(*) AS rowcount FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)")
def count_rows(spark, folder):
    return row_count(QuerySpec(Dataset(table(spark, folder, "orders")), columns=["o_custkey", "o_orderstatus"], metrics=[]))


@R.add("grand_total", "SELECT round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def total(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "orders")), columns=["o_custkey"], filters=[Filter("o_orderstatus", "==", "F")],
        metrics=[Metric("total", "o_totalprice", "SUM"), Metric("n", aggregate="COUNT")],
        orderby=[("o_custkey", True)], row_limit=10,
    )
    return rounded(grand_total(spec), 2, "total")


@R.add("limit_with_flag", "SELECT 100 AS fetched, true AS more")
def limit_flag(spark, folder):
    rows, more = ordering.limit_with_flag(table(spark, folder, "orders").select("o_orderkey"), 100)
    return rows.agg(F.count(F.lit(1)).cast("int").alias("fetched")).withColumn("more", F.lit(more))


@R.add("sample_rows", "SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 1000)")
def sample_rows(spark, folder):
    return ordering.samples(table(spark, folder, "lineitem")).agg(F.count(F.lit(1)).alias("n"))


@R.add(
    "drill_detail",
    """SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS total
       FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 20""",
)
def drill(spark, folder):
    rows, count = ordering.drill_detail(table(spark, folder, "orders"), F.col("o_orderstatus") == "P", ["o_orderkey"], 20)
    return rows.select("o_orderkey", "o_totalprice").withColumn("total", count.scalar())


@R.add(
    "aggregate_operators",
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, median(l_extendedprice) AS median,
       quantile_cont(l_extendedprice, 0.9) AS p90, count(l_tax) AS n, count(*) FILTER (WHERE l_tax <> 0) AS taxed,
       round(stddev_samp(l_quantity), 6) AS std, round(var_samp(l_quantity), 6) AS var, sum(l_quantity) AS sum,
       min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem GROUP BY 1""",
)
def aggregate_operators(spark, folder):
    result = aggregate(
        table(spark, folder, "lineitem"), ["l_returnflag"],
        {
            "mean": ("l_quantity", "mean"), "median": ("l_extendedprice", "median"),
            "p90": ("l_extendedprice", "percentile", {"q": 90}), "n": ("l_tax", "count"), "taxed": ("l_tax", "count_nonzero"),
            "std": ("l_quantity", "std"), "var": ("l_quantity", "var"), "sum": ("l_quantity", "sum"),
            "first": ("l_shipdate", "min"), "last": ("l_shipdate", "max"),
        },
    )
    return rounded(result, 6, "mean", "std", "var")


@R.add(
    "aggregate_positions",
    """WITH r AS (SELECT event_type, value, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS p FROM events)
       SELECT event_type, arg_min(p, (value, p)) AS lowest, arg_max(p, (value, -p)) AS highest FROM r GROUP BY 1""",
)
def aggregate_positions(spark, folder):
    events = table(spark, folder, "events")
    return aggregate(
        events, ["event_type"], {"lowest": ("value", "argmin"), "highest": ("value", "argmax")}, order="event_id"
    )


@R.add(
    "aggregate_product",
    "SELECT event_type, round(sum(ln(1 + value / 1000000)), 6) AS log_product FROM events GROUP BY 1",
)
def aggregate_product(spark, folder):
    events = table(spark, folder, "events").withColumn("f", 1 + F.col("value") / 1000000)
    result = aggregate(events, ["event_type"], {"p": ("f", "prod")})
    return result.select("event_type", F.round(F.ln("p"), 6).alias("log_product"))


@R.add(
    "top3_brands_monthly",
    """WITH b AS (SELECT p_brand AS brand, l_extendedprice AS v, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS __timestamp
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
       t AS (SELECT brand FROM b GROUP BY 1 ORDER BY sum(v) DESC, brand LIMIT 3)
       SELECT __timestamp, brand, round(sum(v), 2) AS revenue FROM b WHERE brand IN (SELECT brand FROM t) GROUP BY 1, 2""",
)
def top3_brands_monthly(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("brand"))
    wide = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    spec = QuerySpec(
        Dataset(wide, time_col="o_orderdate"), columns=["brand"], metrics=[Metric("revenue", "l_extendedprice", "SUM")],
        is_timeseries=True, grain="P1M", series_columns=["brand"], series_limit=3,
    )
    return rounded(run_query(spec), 2, "revenue")


@R.add(
    "bottom_segments_by_count",
    """WITH t AS (SELECT nullif(c_mktsegment, 'BUILDING') AS s FROM customer),
       k AS (SELECT s FROM t GROUP BY 1 ORDER BY count(*), s NULLS FIRST LIMIT 2)
       SELECT s AS segment, count(*) AS n FROM t WHERE EXISTS (SELECT 1 FROM k WHERE k.s IS NOT DISTINCT FROM t.s) GROUP BY 1""",
)
def bottom_segments(spark, folder):
    customers = table(spark, folder, "customer").select(F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"))
    kept = top_series(customers, ["segment"], F.count(F.lit(1)), 2, desc=False)
    return kept.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@R.add(
    "in_listed_groups",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE (o_orderstatus, o_orderpriority) IN
       (SELECT o_orderstatus, o_orderpriority FROM orders GROUP BY 1, 2 HAVING avg(o_totalprice) > (SELECT avg(o_totalprice) FROM orders))
       GROUP BY 1, 2""",
)
def in_listed_groups(spark, folder):
    orders = table(spark, folder, "orders")
    mean = orders.agg(F.avg("o_totalprice")).scalar()
    groups = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.avg("o_totalprice").alias("a")).where(F.col("a") > mean)
    kept = in_groups(orders, groups.drop("a"), ["o_orderstatus", "o_orderpriority"])
    return kept.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@R.add(
    "country_lookup",
    """SELECT c_custkey, n_name AS country, CASE WHEN n_nationkey IS NOT NULL THEN 'N' || CAST(n_nationkey AS VARCHAR) ELSE 'XXX' END AS cca3
       FROM customer LEFT JOIN nation ON CASE WHEN c_acctbal < 0 THEN 99 ELSE c_nationkey END = n_nationkey""",
)
def country_lookup(spark, folder):
    nation = table(spark, folder, "nation")
    dimension = nation.select(
        F.col("n_nationkey").alias("cioc"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("cca3"),
        F.col("n_name").alias("name"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lng"),
    )
    # customers in debt carry a code no country has
    coded = table(spark, folder, "customer").withColumn("code", F.expr("CASE WHEN c_acctbal < 0 THEN 99 ELSE c_nationkey END"))
    found = joins.lookup_country(coded, "code", dimension, "cioc")
    return found.select("c_custkey", "country", "cca3")


@R.add(
    "double_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, s_nation, c_nation, a.n_name AS n_name, a.n_regionkey AS n_regionkey,
       b.n_name AS n_name__1, b.n_regionkey AS n_regionkey__1
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey AS s_nation, c_nationkey AS c_nation FROM lineitem
             JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
       LEFT JOIN nation a ON s_nation = a.n_nationkey LEFT JOIN nation b ON c_nation = b.n_nationkey""",
)
def double_lookup(spark, folder):
    return joins.double_lookup(trade(spark, folder), table(spark, folder, "nation"), "n_nationkey", "s_nation", "c_nation")


def trade(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the nation of the supplier and of the buyer."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("s_nation"))
    heads = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    buyers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("c_nation"))
    owners = heads.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nation")
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "s_nation", "c_nation")


@R.add(
    "virtual_dataset_join",
    """SELECT c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def virtual_dataset_join(spark, folder):
    for name in ("customer", "nation", "region"):
        table(spark, folder, name).createOrReplaceTempView(f"virtual_{name}")
    virtual = spark.sql(
        """SELECT c_name, n_name, r_name FROM virtual_customer JOIN virtual_nation ON c_nationkey = n_nationkey
           JOIN virtual_region ON n_regionkey = r_regionkey"""
    )
    return run_query(QuerySpec(Dataset(virtual), columns=["c_name", "n_name", "r_name"]))


@R.add(
    "yoy_revenue_compare",
    """WITH g AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS t, o_orderstatus AS s, sum(o_totalprice) AS v
         FROM orders GROUP BY 1, 2)
       SELECT a.t AS __timestamp, a.s AS o_orderstatus, round(a.v, 2) AS revenue, round(b.v, 2) AS "revenue__1 year ago",
         round_even(((a.v - b.v) / b.v), 4) AS change
       FROM g a LEFT JOIN g b ON a.s = b.s AND b.t + INTERVAL 1 YEAR = a.t
       WHERE a.t >= TIMESTAMP '1996-01-01' AND a.t < TIMESTAMP '1998-01-01'""",
)
def yoy_revenue_compare(spark, folder):
    dataset = Dataset(table(spark, folder, "orders"), time_col="o_orderdate")
    spec = QuerySpec(
        dataset, columns=["o_orderstatus"], metrics=[Metric("revenue", "o_totalprice", "SUM")], is_timeseries=True, grain="P1M",
        since=datetime(1996, 1, 1), until=datetime(1998, 1, 1), time_offsets=["1 year ago"],
        post_processing=[("compare", {"sources": ["revenue"], "others": ["revenue__1 year ago"], "kind": "percentage"})],
    )
    result = run_query(spec).withColumnRenamed("percentage__revenue__revenue__1 year ago", "change")
    return rounded(result, 2, "revenue", "revenue__1 year ago")


@R.add(
    "lines_deduplicated",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
       ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def lines_deduplicated(spark, folder):
    kept = ordering.dedup(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"],
        [F.desc("l_shipdate"), F.desc("l_linenumber"), F.desc("l_suppkey"), F.desc("l_extendedprice")],
    )
    return kept.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")


@R.add(
    "derived_grain_dimension",
    """SELECT CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP) AS ship_quarter, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def derived_grain_dimension(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "lineitem")),
        columns=[Dimension("ship_quarter", "l_shipdate", "P3M"), "l_returnflag"], metrics=[Metric("n", aggregate="COUNT")],
    )
    return run_query(spec)
