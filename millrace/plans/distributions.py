"""Queries of distributions, binning, tests and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality, stats
from millrace.plans.base import Entry, Register, daily, rounded, table

R = Register()
ENTRIES = R.entries

_RANKS = """r AS (SELECT l_returnflag AS f, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS k,
  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
q AS (SELECT f, max(n) AS n, avg(x) AS mean, median(x) AS median, min(x) AS least, max(x) AS most,
  quantile_cont(x, 0.1) AS p10, quantile_cont(x, 0.9) AS p90,
  (max(x) FILTER (WHERE k = floor(0.25 * (n - 1))) + max(x) FILTER (WHERE k = ceil(0.25 * (n - 1)))) / 2 AS q1,
  (max(x) FILTER (WHERE k = floor(0.75 * (n - 1))) + max(x) FILTER (WHERE k = ceil(0.75 * (n - 1)))) / 2 AS q3 FROM r GROUP BY 1)"""


def _box_entry(whisker: str, high: str, low: str, extreme: bool, percentiles=None) -> Entry:
    """Narrowed prices, so that Tukey whiskers leave values outside."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        box = stats.boxplot(table(spark, folder, "lineitem"), ["l_returnflag"], ["l_extendedprice"], whisker, percentiles)
        return rounded(
            box, 4, *[f"l_extendedprice__{s}" for s in ("mean", "median", "max", "min", "q1", "q3")]
        )

    top = f"max(x) FILTER (WHERE x <= {high})" if extreme else f"max({high})"
    bottom = f"min(x) FILTER (WHERE x >= {low})" if extreme else f"max({low})"
    sql = f"""WITH {_RANKS} SELECT r.f AS l_returnflag, round(max(mean), 4) AS l_extendedprice__mean, round(max(median), 4) AS l_extendedprice__median,
      round({top}, 4) AS l_extendedprice__max, round({bottom}, 4) AS l_extendedprice__min, round(max(q1), 4) AS l_extendedprice__q1,
      round(max(q3), 4) AS l_extendedprice__q3, max(q.n) AS l_extendedprice__count,
      count(*) FILTER (WHERE x > {high} OR x < {low}) AS l_extendedprice__outliers FROM r JOIN q ON r.f = q.f GROUP BY 1"""
    return Entry(run, sql)


ENTRIES["boxplot_price_by_flag"] = _box_entry("tukey", "q3 + 1.5 * (q3 - q1)", "q1 - 1.5 * (q3 - q1)", True)
ENTRIES["boxplot_percentile_whiskers"] = _box_entry("percentile", "p90", "p10", False, [10, 90])
ENTRIES["boxplot_full_range"] = _box_entry("min/max", "most", "least", True)


@R.add(
    "boxplot_outlying_orders",
    """WITH s AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1), c AS (SELECT c_mktsegment AS g, round(v, 2) AS v FROM s JOIN customer ON o_custkey = c_custkey),
       r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY v) - 1 AS k, count(*) OVER (PARTITION BY g) AS n FROM c),
       q AS (SELECT g, (max(v) FILTER (WHERE k = floor(0.25 * (n - 1))) + max(v) FILTER (WHERE k = ceil(0.25 * (n - 1)))) / 2 AS q1,
         (max(v) FILTER (WHERE k = floor(0.75 * (n - 1))) + max(v) FILTER (WHERE k = ceil(0.75 * (n - 1)))) / 2 AS q3 FROM r GROUP BY 1)
       SELECT r.g AS segment, v AS value, CASE WHEN v > q3 + 1.5 * (q3 - q1) THEN 'above' ELSE 'below' END AS side, count(*) AS n
       FROM r JOIN q ON r.g = q.g WHERE v > q3 + 1.5 * (q3 - q1) OR v < q1 - 1.5 * (q3 - q1) GROUP BY 1, 2, 3""",
)
def boxplot_outlying_orders(spark, folder):
    spent = table(spark, folder, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    buyers = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    joined = spent.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("segment", "v")
    return stats.boxplot_outliers(joined, ["segment"], "v")


_BINS = """b AS (SELECT c_mktsegment AS g, c_acctbal AS x, (SELECT min(c_acctbal) FROM customer) AS lo, (SELECT max(c_acctbal) FROM customer) AS hi FROM customer),
n AS (SELECT g, CAST(least(floor((x - lo) * 15 / (hi - lo)), 14) AS INTEGER) AS bin, count(*) AS n, max(lo) AS lo, max(hi) AS hi FROM b GROUP BY 1, 2),
a AS (SELECT g.g, k.bin, coalesce(n.n, 0) AS n, e.lo, e.hi FROM (SELECT DISTINCT g FROM b) g CROSS JOIN (SELECT CAST(unnest(range(15)) AS INTEGER) AS bin) k
  CROSS JOIN (SELECT max(lo) AS lo, max(hi) AS hi FROM b) e LEFT JOIN n ON n.g = g.g AND n.bin = k.bin)"""


def _histogram_entry(expression: str, digits: int | None, **options) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        frame = table(spark, folder, "customer").withColumn("g", F.col("c_mktsegment"))
        bins = rounded(stats.histogram(frame, "c_acctbal", 15, ["g"], **options), 4, "bin_start", "bin_end")
        return bins if digits is None else rounded(bins, digits, "count")

    return Entry(
        run,
        f"""WITH {_BINS} SELECT g, bin, round(lo + bin * (hi - lo) / 15, 4) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 15, 4) AS bin_end,
            {expression} AS count FROM a""",
    )


_RUN = "PARTITION BY g ORDER BY bin ROWS UNBOUNDED PRECEDING"
ENTRIES["histogram_acctbal"] = _histogram_entry("n", None)
ENTRIES["histogram_normalized"] = _histogram_entry("round(n / sum(n) OVER (PARTITION BY g), 6)", 6, normalized=True)
ENTRIES["histogram_cumulative"] = _histogram_entry(f"CAST(sum(n) OVER ({_RUN}) AS BIGINT)", None, cumulative=True)


@R.add(
    "price_buckets",
    """WITH e AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part), d AS (SELECT lo, hi, (hi - lo) / 10 AS w FROM e),
       g AS (SELECT lo, hi, w, CAST(greatest(0, ceil(log10(1 / w))) AS INTEGER) AS digits FROM d),
       k AS (SELECT round((CASE WHEN lo < round(lo, digits) THEN lo - 1 ELSE lo END) + i * w, digits) AS edge
             FROM g, range(0, 12) r(i) WHERE i <= 10 + CASE WHEN hi > round(hi, digits) THEN 1 ELSE 0 END)
       SELECT p_partkey, CAST((SELECT count(*) FROM k WHERE k.edge <= p_retailprice) AS INTEGER) AS bucket FROM part""",
)
def price_buckets(spark, folder):
    parts = table(spark, folder, "part")
    edges = stats.break_points(parts, "p_retailprice", 10)
    return stats.bucketize(parts, "p_retailprice", edges).select("p_partkey", "bucket")


@R.add(
    "size_buckets_given",
    "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 3 WHEN p_size >= 25 THEN 2 WHEN p_size >= 10 THEN 1 ELSE 0 END AS bucket FROM part",
)
def size_buckets_given(spark, folder):
    parts = table(spark, folder, "part")
    return stats.bucketize(parts, "p_size", stats.break_points(parts, "p_size", breaks=[25, 10, 40])).select("p_partkey", "bucket")


_HEAT = "h AS (SELECT o_orderpriority AS x, year(o_orderdate) AS y, count(*) AS v FROM orders GROUP BY 1, 2)"


def _heat_entry(across: str, part: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        orders = table(spark, folder, "orders")
        cells = orders.groupBy(F.col("o_orderpriority").alias("x"), F.year("o_orderdate").cast("bigint").alias("y"))
        return rounded(stats.normalize_cells(cells.agg(F.count(F.lit(1)).alias("v")), "x", "y", "v", across), 6, "perc", "rank")

    rank = f"(rank() OVER ({part} ORDER BY v) + (count(*) OVER ({part + (' , v' if part else 'PARTITION BY v')}) - 1) / 2) / count(*) OVER ({part})"
    return Entry(
        run,
        f"""WITH {_HEAT} SELECT x, y, v, round((v - min(v) OVER ({part})) / (max(v) OVER ({part}) - min(v) OVER ({part})), 6) AS perc,
            round({rank}, 6) AS rank FROM h""",
    )


ENTRIES["heatmap_norm"] = _heat_entry("heatmap", "")
ENTRIES["heatmap_norm_by_x"] = _heat_entry("x", "PARTITION BY x")
ENTRIES["heatmap_norm_by_y"] = _heat_entry("y", "PARTITION BY y")


_TTEST = """WITH d AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1, 2),
p AS (SELECT a.event_type, b.v - a.v AS d, a.v, b.v AS c FROM d a JOIN d b ON a.day = b.day AND b.event_type = 'view' WHERE a.event_type <> 'view'),
s AS (SELECT event_type, count(*) AS n, sum(d) AS sd, sum(d * d) AS sdd, sum(v) AS sv, sum(c) AS sc FROM p GROUP BY 1)
SELECT event_type, n, round(-abs(sd * sqrt((n - 1) / (n * sdd - sd * sd))), 6) AS t, round((sv - sc) / sc * 100, 6) AS lift FROM s"""


@R.add("ttest_event_types", _TTEST)
def ttest_event_types(spark, folder):
    tested = stats.paired_ttest(daily(table(spark, folder, "events"), "event_type"), "day", "event_type", "v", "view", False)
    return rounded(tested, 6, "t", "lift")


@R.add(
    "ttest_p_values",
    """WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, sum(value) AS v FROM events GROUP BY 1, 2),
       s AS (SELECT a.event_type, count(*) AS n, sum(b.v - a.v) AS d, sum((b.v - a.v) * (b.v - a.v)) AS dd
             FROM d a JOIN d b ON a.day = b.day AND b.event_type = 'view' WHERE a.event_type <> 'view' GROUP BY 1),
       t AS (SELECT event_type, n - 1 AS k, (n - 1) % 2 AS odd, atan(abs(d * sqrt((n - 1) / (n * dd - d * d))) / sqrt(n - 1)) AS angle FROM s),
       f AS (SELECT *, CASE WHEN odd = 1 THEN cos(angle) ELSE 1 END * (1 + coalesce(list_sum(list_transform(range(1, (k - odd) // 2),
               lambda i: exp(list_sum(list_transform(range(1, i + 1), lambda j: ln(cos(angle) * cos(angle) * (2 * j - 1 + odd) / (2 * j + odd))))))), 0)) AS total
             FROM t)
       SELECT event_type, round(greatest(0, 1 - CASE WHEN odd = 0 THEN sin(angle) * total WHEN k = 1 THEN 2 / pi() * angle
              ELSE 2 / pi() * (angle + sin(angle) * total) END), 9) AS p FROM f""",
)
def ttest_p_values(spark, folder):
    tested = stats.paired_ttest(daily(table(spark, folder, "events"), "event_type"), "day", "event_type", "v", "view")
    return rounded(tested.select("event_type", "p"), 9, "p")


@R.add(
    "pair_with_control",
    """WITH d AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, round(sum(value), 4) AS v FROM events GROUP BY 1, 2)
       SELECT a.event_type, a.day, a.v, b.v AS control_value FROM d a JOIN d b ON a.day = b.day AND b.event_type = 'view' WHERE a.event_type <> 'view'""",
)
def pair_with_control(spark, folder):
    days = rounded(daily(table(spark, folder, "events"), "event_type"), 4, "v")
    return stats.pair_with_control(days, "day", "event_type", "v", "view")


@R.add(
    "quality_lineitem",
    """SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM lineitem
       UNION ALL SELECT 'Column', 'l_tax', 'Completeness', round(count(nullif(l_tax, 0)) / count(*), 6) FROM lineitem
       UNION ALL SELECT 'Column', 'l_orderkey', 'Completeness', 1 FROM lineitem LIMIT 1 OFFSET 0""".replace(
        " FROM lineitem LIMIT 1 OFFSET 0", ""
    )
    + " UNION ALL SELECT 'Column', 'l_quantity', 'Mean', round(avg(l_quantity), 6) FROM lineitem",
)
def quality_lineitem(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return rounded(quality.quality_metrics(lines, ["l_tax", "l_orderkey"], ["l_quantity"]), 6, "value")


@R.add(
    "quality_checks",
    """SELECT 'Warning' AS check_level, 'isComplete(c_name)' AS check_name, count(*) FILTER (WHERE c_name IS NULL) AS violations, 'Success' AS status FROM customer
       UNION ALL SELECT 'Warning', 'isPositive(c_acctbal)', count(*) FILTER (WHERE NOT c_acctbal > 0),
         CASE WHEN count(*) FILTER (WHERE NOT c_acctbal > 0) = 0 THEN 'Success' ELSE 'Failure' END FROM customer
       UNION ALL SELECT 'Warning', 'isNonNegative(c_nationkey)', count(*) FILTER (WHERE c_nationkey < 0), 'Success' FROM customer""",
)
def quality_checks(spark, folder):
    checks = [("isComplete", "c_name"), ("isPositive", "c_acctbal"), ("isNonNegative", "c_nationkey")]
    return quality.quality_checks(table(spark, folder, "customer"), checks)


def _profile_sql(source: str, columns: dict[str, str], exact: bool) -> str:
    """Statistics of every column, computed; ``exact`` adds distinct values and flags that the sketches kept their error."""
    parts = []
    for name, kind in columns.items():
        number = kind in ("int", "bigint", "double")
        stats = [f"CAST(min({name}) AS DOUBLE)", f"CAST(max({name}) AS DOUBLE)", f"round(avg({name}), 6)", f"round(CAST(sum({name}) AS DOUBLE), 4)", f"round(stddev_pop({name}), 4)"]
        cells = ", ".join(f"{x if number else 'CAST(NULL AS DOUBLE)'} AS {y}" for x, y in zip(stats, ('"min"', '"max"', "mean", '"sum"', "std")))
        more = f", count(DISTINCT {name}) AS \"distinct\", true AS distinct_within, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_within" if exact else ""
        parts.append(f"""SELECT '{name}' AS "column", '{kind}' AS type, count({name}) / count(*) AS completeness, {cells}{more} FROM {source}""")
    return " UNION ALL ".join(parts)


CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}
ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


def _rounded_profile(profile: DataFrame) -> DataFrame:
    return rounded(rounded(profile, 6, "mean"), 4, "sum", "std")


@R.add("profile_customer", _profile_sql("customer", CUSTOMER, False))
def profile_customer(spark, folder):
    return _rounded_profile(quality.column_profile(table(spark, folder, "customer"), approximate=False))


@R.add("profile_orders_approximate", _profile_sql("orders", ORDERS, True))
def profile_orders_approximate(spark, folder):
    """Sketches of each order status, merged, beside exact values."""
    checked = quality.checked_profile(table(spark, folder, "orders"), parts=["o_orderstatus"])
    return _rounded_profile(checked).drop("approx_distinct", "quartiles")


def _rules_sql(source: str, columns: dict[str, str]) -> str:
    parts = []
    for name, kind in columns.items():
        rules = [
            (f"count({name}) = count(*)", "CompleteIfComplete", f"'{name} is not null'"),
            (f"count({name}) > 0.2 * count(*) AND count({name}) < count(*)", "RetainCompleteness", f"""'completeness({name}) >= ' || format('{{:.2f}}',
               count({name}) / count(*) - 1.96 * sqrt(count({name}) / count(*) * (1 - count({name}) / count(*)) / count(*)))"""),
            (f"count({name}) > 0 AND count(DISTINCT {name}) >= 0.95 * count({name})", "UniqueIfApproximatelyUnique", f"'{name} is unique'"),
        ]
        if kind == "string":
            rules.append((f"count({name}) > 0 AND count(*) FILTER (regexp_full_match({name}, '-?[0-9]+(\\.[0-9]+)?')) = count({name})", "RetainType", f"'{name} is numeric'"))
        else:
            rules.append((f"count({name}) > 0 AND count(*) FILTER ({name} < 0) = 0", "NonNegativeNumbers", f"'{name} >= 0'"))
        parts += [f"""SELECT '{name}' AS "column", '{rule}' AS rule, {text} AS "constraint" FROM {source} HAVING {when}""" for when, rule, text in rules]
    return " UNION ALL ".join(parts)


@R.add("suggested_constraints", _rules_sql("customer", CUSTOMER))
def suggested_constraints(spark, folder):
    return quality.suggest_constraints(table(spark, folder, "customer"))
