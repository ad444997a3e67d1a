"""Queries of pivots, totals, shares and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.grains import time_bucket
from millrace.operators import aggregates, ordering, pivots, project
from millrace.plans.base import Entry, Register, money, rounded, table

R = Register()
ENTRIES = R.entries

STATUS = ("F", "O", "P")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")


def _case(expression: str, value: str, digits: int | None = 2) -> str:
    body = expression.format(f"CASE WHEN {value} THEN o_totalprice END")
    return f"round({body}, {digits})" if digits is not None else body


@R.add(
    "pivot_priority_by_status",
    "SELECT o_orderpriority, "
    + ", ".join(f"""{_case('sum({})', f"o_orderstatus = '{s}'")} AS "total, {s}", {_case('count({})', f"o_orderstatus = '{s}'", None)} AS "n, {s}" """ for s in STATUS)
    + " FROM orders GROUP BY 1",
)
def pivot_priority_by_status(spark, folder):
    wide = pivots.pivot(
        orders(spark, folder), ["o_orderpriority"], ["o_orderstatus"],
        {"total": ("o_totalprice", "sum"), "n": ("o_totalprice", "count")}, labels=STATUS,
    )
    return rounded(wide, 2, *[f"total, {s}" for s in STATUS])


@R.add(
    "pivot_long_totals",
    """SELECT coalesce(o_orderstatus, 'All') AS o_orderstatus, coalesce(CAST(o_custkey AS VARCHAR), 'All') AS label, round(sum(o_totalprice), 2) AS total, count(*) AS n
       FROM orders GROUP BY CUBE (o_orderstatus, o_custkey)""",
)
def pivot_long_totals(spark, folder):
    """A label for every customer, as rows, with the totals of rows and columns."""
    aggs = {"total": ("o_totalprice", "sum"), "n": ("o_totalprice", "count")}
    return rounded(pivots.pivot_long(orders(spark, folder), ["o_orderstatus"], ["o_custkey"], aggs, margins=True), 2, "total")


@R.add(
    "pivot_table_long_totals",
    """WITH g AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, CAST(o_custkey AS VARCHAR) AS c, o_totalprice AS v FROM orders)
       SELECT CASE WHEN grouping(y) = 1 THEN 'Total (Sum)' ELSE CAST(y AS VARCHAR) END AS y,
         CASE WHEN grouping(y) = 1 THEN '' WHEN grouping(p) = 1 THEN 'Subtotal' ELSE p END AS p,
         CASE WHEN grouping(c) = 1 THEN 'Total (Sum)' ELSE c END AS label, round(sum(v), 2) AS v FROM g
       GROUP BY GROUPING SETS ((y, p, c), (y, c), (c), (y, p), (y), ())""",
)
def pivot_table_long_totals(spark, folder):
    frame = orders(spark, folder).select(F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("v"))
    return rounded(pivots.pivot_table_long(frame, ["y", "p"], ["c"], ["v"], row_totals=True, col_totals=True), 2, "v")


@R.add(
    "pivot_null_labels_combined",
    "SELECT o_orderpriority, "
    + ", ".join(
        f"""{_case('avg({})', c, 6)} AS "{s}, mean", {_case('max({})', c)} AS "{s}, top" """
        for s, c in (("<NULL>", "o_orderstatus = 'P'"), ("F", "o_orderstatus = 'F'"), ("O", "o_orderstatus = 'O'"))
    )
    + " FROM orders GROUP BY 1",
)
def pivot_null_labels_combined(spark, folder):
    frame = orders(spark, folder).withColumn("s", F.expr("nullif(o_orderstatus, 'P')"))
    wide = pivots.pivot(
        frame, ["o_orderpriority"], ["s"], {"mean": ("o_totalprice", "mean"), "top": ("o_totalprice", "max")}, combine=True
    )
    return rounded(rounded(wide, 6, *[c for c in wide.columns if c.endswith("mean")]), 2, *[c for c in wide.columns if c.endswith("top")])


@R.add(
    "pivot_with_margins",
    "SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, "
    + ", ".join(f"""{_case('sum({})', f"o_orderstatus = '{s}'")} AS "total, {s}" """ for s in STATUS)
    + """, round(sum(o_totalprice), 2) AS "total, All" FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def pivot_with_margins(spark, folder):
    wide = pivots.pivot(
        orders(spark, folder), ["o_orderpriority"], ["o_orderstatus"], {"total": ("o_totalprice", "sum")}, margins=True
    )
    return rounded(wide, 2, *[c for c in wide.columns if c.startswith("total")])


@R.add(
    "pivot_median",
    "SELECT o_orderpriority, "
    + ", ".join(f"""{_case('median({})', f"o_orderstatus = '{s}'", 4)} AS "middle, {s}" """ for s in STATUS)
    + " FROM orders GROUP BY 1",
)
def pivot_median(spark, folder):
    wide = pivots.pivot(orders(spark, folder), ["o_orderpriority"], ["o_orderstatus"], {"middle": ("o_totalprice", "median")})
    return rounded(wide, 4, *[f"middle, {s}" for s in STATUS])


@R.add(
    "flat_cell_names",
    """SELECT 'sum(a\\, b), ' || o_orderstatus || ', ' || o_orderpriority AS column_name, count(*) AS n FROM orders GROUP BY 1""",
)
def flat_cell_names(spark, folder):
    cells = orders(spark, folder).groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return pivots.flatten(cells, "sum(a, b)", ["o_orderstatus", "o_orderpriority"]).select("column_name", "n")


@R.add(
    "rename_flat_labels",
    "SELECT o_orderpriority, "
    + ", ".join(f"""{_case('max({})', f"o_orderstatus = '{s}'")} AS "{s}" """ for s in STATUS)
    + " FROM orders GROUP BY 1",
)
def rename_flat_labels(spark, folder):
    wide = pivots.pivot(orders(spark, folder), ["o_orderpriority"], ["o_orderstatus"], {"top": ("o_totalprice", "max")})
    return rounded(project.rename_op(wide, {"top": None}, level=0), 2, *STATUS)


_TOTALS = """WITH g AS (SELECT year(o_orderdate) AS y, o_orderpriority AS p, o_orderstatus AS s, o_totalprice AS v FROM orders),
l AS (SELECT CASE WHEN grouping(y) = 1 THEN '{total}' ELSE CAST(y AS VARCHAR) END AS y,
  CASE WHEN grouping(y) = 1 THEN '' WHEN grouping(p) = 1 THEN 'Subtotal' ELSE p END AS p,
  CASE WHEN grouping(s) = 1 THEN '{total}' ELSE s END AS s, {agg} AS v FROM g
  GROUP BY GROUPING SETS ((y, p, s), (y, s), (s), (y, p), (y), ()))
SELECT y, p, """ + ", ".join(f"""round(max(v) FILTER (WHERE s = '{s}'), {{digits}}) AS "v, {s}" """ for s in STATUS) + """,
  round(max(v) FILTER (WHERE s = '{total}'), {digits}) AS "v, {total}" FROM l GROUP BY 1, 2"""


def _totals_entry(agg: str, expression: str, digits: int) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        frame = orders(spark, folder).select(
            F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"), F.col("o_orderstatus").alias("s"),
            F.col("o_totalprice").alias("v"),
        )
        wide = pivots.pivot_table(frame, ["y", "p"], ["s"], ["v"], agg, row_totals=True, col_totals=True)
        return rounded(wide, digits, *[c for c in wide.columns if c.startswith("v, ")])

    return Entry(run, _TOTALS.format(total=f"Total ({agg})", agg=expression, digits=digits))


ENTRIES["pivot_totals_all_levels"] = _totals_entry("Sum", "sum(v)", 3)
ENTRIES["pivot_totals_average"] = _totals_entry("Average", "avg(v)", 6)
ENTRIES["pivot_totals_maximum"] = _totals_entry("Maximum", "max(v)", 2)
ENTRIES["pivot_totals_deviation"] = _totals_entry("Sample Standard Deviation", "CASE WHEN count(v) > 1 THEN stddev_samp(v) ELSE 0 END", 6)


@R.add(
    "pivot_metrics_on_rows",
    "WITH g AS (SELECT o_orderpriority, o_orderstatus, sum(o_totalprice) AS v, CAST(sum(o_custkey) AS DOUBLE) AS k FROM orders GROUP BY 1, 2), "
    "m AS (SELECT 'v' AS metric_name, o_orderstatus, o_orderpriority, v AS x FROM g UNION ALL SELECT 'k', o_orderstatus, o_orderpriority, k FROM g) "
    "SELECT metric_name, o_orderstatus, "
    + ", ".join(f"""round(max(x) FILTER (WHERE o_orderpriority = '{p}'), 2) AS "value, {p}" """ for p in PRIORITIES)
    + " FROM m GROUP BY 1, 2",
)
def pivot_metrics_on_rows(spark, folder):
    frame = orders(spark, folder).select(
        "o_orderpriority", "o_orderstatus", F.col("o_totalprice").alias("v"), F.col("o_custkey").cast("double").alias("k")
    )
    wide = pivots.pivot_table(
        frame, ["o_orderpriority"], ["o_orderstatus"], ["v", "k"], "Sum", transpose=True, metrics_on_rows=True
    )
    return rounded(wide, 2, *[f"value, {p}" for p in PRIORITIES])


# ---- the twenty cell aggregators ---------------------------------------------------------

_CELL_SQL = {
    "Count": "count(v)",
    "Count Unique Values": "count(DISTINCT v)",
    "Sum": "round(sum(v), 2)",
    "Integer Sum": "CAST(sum(CAST(trunc(v) AS BIGINT)) AS BIGINT)",
    "Average": "round(avg(v), 6)",
    "Median": "round(median(v), 4)",
    "Sample Variance": "round(CASE WHEN count(v) > 1 THEN var_samp(v) ELSE 0 END, 0)",
    "Sample Standard Deviation": "round(CASE WHEN count(v) > 1 THEN stddev_samp(v) ELSE 0 END, 4)",
    "Minimum": "min(v)",
    "Maximum": "max(v)",
    "First": "min(v)",
    "Last": "max(v)",
    "Sum over Sum": "round(sum(v) / sum(k), 4)",
    "Sum as Fraction of Total": "round(sum(v) / sum(sum(v)) OVER (), 6)",
    "Sum as Fraction of Rows": "round(sum(v) / sum(sum(v)) OVER (PARTITION BY r), 6)",
    "Sum as Fraction of Columns": "round(sum(v) / sum(sum(v)) OVER (PARTITION BY c), 6)",
    "Count as Fraction of Total": "round(count(v) / sum(count(v)) OVER (), 6)",
    "Count as Fraction of Rows": "round(count(v) / sum(count(v)) OVER (PARTITION BY r), 6)",
    "Count as Fraction of Columns": "round(count(v) / sum(count(v)) OVER (PARTITION BY c), 6)",
}
_DIGITS = {"Sum": 2, "Average": 6, "Median": 4, "Sample Variance": 0, "Sample Standard Deviation": 4, "Sum over Sum": 4}


def _cell_entry(name: str, expression: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        frame = orders(spark, folder).select(
            F.col("o_orderpriority").alias("r"), F.col("o_orderstatus").alias("c"), F.col("o_totalprice").alias("v"),
            F.col("o_custkey").alias("k"),
        )
        cells = pivots.pivot_cells(frame, ["r"], ["c"], name, "v", "k")
        digits = 6 if "Fraction" in name else _DIGITS.get(name)
        return cells if digits is None else rounded(cells, digits, "v")

    sql = f"WITH o AS (SELECT o_orderpriority AS r, o_orderstatus AS c, o_totalprice AS v, o_custkey AS k FROM orders) SELECT r, c, {expression} AS v FROM o GROUP BY r, c"
    return Entry(run, sql)


for _name, _expression in _CELL_SQL.items():
    ENTRIES["cell_" + _name.lower().replace(" ", "_")] = _cell_entry(_name, _expression)


@R.add(
    "cell_list_unique_values",
    """SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS v FROM orders GROUP BY 1""",
)
def cell_list_unique(spark, folder):
    frame = orders(spark, folder).select("o_orderstatus", F.col("o_orderpriority").alias("v"))
    return pivots.pivot_cells(frame, ["o_orderstatus"], [], "List Unique Values", "v")


@R.add(
    "cell_first_label_natural",
    """SELECT p_type, 'Brand#' || min(CAST(substr(p_brand, 7) AS INTEGER)) AS p_brand FROM part GROUP BY 1""",
)
def cell_first_label_natural(spark, folder):
    return pivots.pivot_cells(table(spark, folder, "part").select("p_type", "p_brand"), ["p_type"], [], "First", "p_brand")


@R.add("pivot_order_by_key", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY CAST(substr(p_brand, 7) AS INTEGER)")
def pivot_order_by_key(spark, folder):
    """Natural order: Brand#2 comes before Brand#10."""
    counts = table(spark, folder, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return ordering.order_pivot(counts, ["p_brand"], "n", "key_a_to_z")


@R.add("pivot_order_by_value", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, CAST(substr(p_brand, 7) AS INTEGER)")
def pivot_order_by_value(spark, folder):
    counts = table(spark, folder, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    return ordering.order_pivot(counts, ["p_brand"], "n", "value_z_to_a")


# ---- shares ------------------------------------------------------------------------------


@R.add(
    "share_of_column",
    """SELECT o_orderpriority, round(v / sum(v) OVER (), 6) AS v, round(n / sum(n) OVER (), 6) AS n
       FROM (SELECT o_orderpriority, sum(o_totalprice) AS v, count(*) AS n FROM orders GROUP BY 1)""",
)
def share_of_column(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("v"), F.count(F.lit(1)).alias("n"))
    return rounded(aggregates.contribution(grouped, "column", ["v", "n"]), 6, "v", "n")


@R.add(
    "share_of_row",
    """SELECT o_orderpriority, round(f / (f + o), 6) AS f_share, round(o / (f + o), 6) AS o_share FROM (SELECT o_orderpriority,
       sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1)""",
)
def share_of_row(spark, folder):
    f = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("f")
    o = F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("o")
    shared = aggregates.contribution(orders(spark, folder).groupBy("o_orderpriority").agg(f, o), "row", ["f", "o"], ["f_share", "o_share"])
    return rounded(shared.drop("f", "o"), 6, "f_share", "o_share")


@R.add(
    "share_of_total",
    """SELECT o_orderpriority, o_orderstatus, round(v / sum(v) OVER (), 6) AS share, round(v / sum(v) OVER (PARTITION BY o_orderstatus), 6) AS in_status
       FROM (SELECT o_orderpriority, o_orderstatus, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)""",
)
def share_of_total(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    both = pivots.shares(pivots.shares(grouped, "v", []), "v", ["o_orderstatus"], "in_status")
    return rounded(both.drop("v"), 6, "share", "in_status")


@R.add(
    "percent_metrics",
    """SELECT c_mktsegment, round(v, 2) AS v, round(v / sum(v) OVER (), 6) AS "%v" FROM (SELECT c_mktsegment, sum(c_acctbal) AS v FROM customer GROUP BY 1)""",
)
def percent_metrics(spark, folder):
    grouped = table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("v"))
    return rounded(rounded(aggregates.percent_metrics(grouped, ["v"]), 6, "%v"), 2, "v")


@R.add(
    "stack_scale",
    """WITH g AS (SELECT o_orderpriority, o_orderstatus, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
       SELECT o_orderpriority, o_orderstatus, round(v, 2) AS v, round(sum(v) OVER w, 2) AS stack_total, round(v / sum(v) OVER w, 6) AS share,
         round(0.05 * sum(v) OVER w, 4) AS threshold FROM g WINDOW w AS (PARTITION BY o_orderpriority)""",
)
def stack_scale(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    scaled = aggregates.category_scale(grouped, "o_orderpriority", "o_orderstatus", "v", 0.05)
    return rounded(rounded(rounded(scaled, 2, "v", "stack_total"), 4, "threshold"), 6, "share")


# ---- roll-ups ----------------------------------------------------------------------------


def regional(spark: SparkSession, folder: str) -> DataFrame:
    """Spending per region, nation and market segment, folded per customer before the lookups."""
    spent = table(spark, folder, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    buyers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("nation"))
    region = table(spark, folder, "region").select("r_regionkey", F.col("r_name").alias("region"))
    joined = spent.join(buyers, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("region", "nation", "segment", "v")


_REGIONAL = """r AS (SELECT r_name AS region, n_name AS nation, c_mktsegment AS segment, v FROM
  (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
LEVELS = ["region", "nation", "segment"]
_LEVEL = "3 - grouping(region) - grouping(nation) - grouping(segment)"


@R.add("region_nation_segment_rollup", f"WITH {_REGIONAL} SELECT region, nation, segment, {_LEVEL} AS level, round(sum(v), 2) AS v FROM r GROUP BY ROLLUP (region, nation, segment)")
def region_rollup(spark, folder):
    return rounded(aggregates.rollup_levels(regional(spark, folder), LEVELS, ["v"]), 2, "v")


@R.add("region_rollup_mean", f"WITH {_REGIONAL} SELECT region, nation, segment, {_LEVEL} AS level, round(avg(v), 6) AS v FROM r GROUP BY ROLLUP (region, nation, segment)")
def region_rollup_mean(spark, folder):
    return rounded(aggregates.rollup_levels(regional(spark, folder), LEVELS, ["v"], "mean"), 6, "v")


_YEARLY = "y AS (SELECT CAST(date_trunc('year', o_orderdate) AS TIMESTAMP) AS t, o_orderstatus, o_orderpriority, o_totalprice AS v FROM orders)"


def yearly(spark: SparkSession, folder: str) -> DataFrame:
    return orders(spark, folder).select(
        time_bucket("o_orderdate", "P1Y").alias("t"), "o_orderstatus", "o_orderpriority", F.col("o_totalprice").alias("v")
    )


def _change_entry(kind: str, expression: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        changed = aggregates.rollup_change(yearly(spark, folder), ["o_orderstatus", "o_orderpriority"], "t", ["v"], kind)
        return rounded(changed, 4, "v")

    a = "coalesce(sum(v) FILTER (WHERE t = (SELECT max(t) FROM y)), 0)"
    b = "coalesce(sum(v) FILTER (WHERE t = (SELECT min(t) FROM y)), 0)"
    return Entry(
        run,
        f"""WITH {_YEARLY} SELECT o_orderstatus, o_orderpriority, 2 - grouping(o_orderstatus) - grouping(o_orderpriority) AS level,
            round({expression.format(a=a, b=b)}, 4) AS v FROM y WHERE t IN ((SELECT max(t) FROM y), (SELECT min(t) FROM y))
            GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    )


for _kind, _expression in {"point_diff": "{a} - {b}", "point_factor": "{a} / {b}", "point_percent": "{a} / {b} - 1"}.items():
    ENTRIES[f"rollup_{_kind}"] = _change_entry(_kind, _expression)


@R.add(
    "rollup_per_year",
    f"""WITH {_YEARLY} SELECT t, o_orderstatus, o_orderpriority, 2 - grouping(o_orderstatus) - grouping(o_orderpriority) AS level, round(sum(v), 2) AS v
        FROM y GROUP BY GROUPING SETS ((t), (t, o_orderstatus), (t, o_orderstatus, o_orderpriority))""",
)
def rollup_per_year(spark, folder):
    return rounded(aggregates.rollup_series(yearly(spark, folder), ["o_orderstatus", "o_orderpriority"], "t", ["v"]), 2, "v")


@R.add("region_tree", f"WITH {_REGIONAL} SELECT region, nation, 2 - grouping(region) - grouping(nation) AS depth, round(sum(v), 2) AS value, round(sum(v), 2) AS value2 FROM r GROUP BY ROLLUP (region, nation)")
def region_tree(spark, folder):
    return rounded(aggregates.tree_rollup(regional(spark, folder), ["region", "nation"], "v"), 2, "value", "value2")


# ---- chart frames ------------------------------------------------------------------------

_CHARTS = {
    "bubble": (["o_orderpriority"], [("sum(o_totalprice)", "x"), ("count(*)", "y"), ("max(o_totalprice)", "size")]),
    "bullet": (["o_orderstatus"], [("sum(o_totalprice)", "value")]),
    "sunburst": (["o_orderstatus", "o_orderpriority"], [("sum(o_totalprice)", "m1"), ("sum(o_totalprice)", "m2")]),
    "parallel": (["o_orderstatus"], [("sum(o_totalprice)", "m1"), ("min(o_totalprice)", "m2"), ("count(*)", "m3")]),
    "dual_line": (["o_orderdate"], [("sum(o_totalprice)", "left"), ("count(*)", "right")]),
    "word_cloud": (["o_orderpriority"], [("count(*)", "size")]),
    "gauge": (["o_orderstatus"], [("avg(o_totalprice)", "value")]),
    "funnel": (["o_orderstatus"], [("sum(o_totalprice)", "value")]),
    "pie": (["o_orderpriority"], [("sum(o_totalprice)", "value")]),
}


def _chart_entry(kind: str, groups: list[str], metrics: list[tuple[str, str]]) -> Entry:
    share, digits = kind in ("pie", "funnel"), 6 if kind == "gauge" else 3
    roles = [r for _, r in metrics]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        given = metrics[:1] if kind == "sunburst" else metrics
        framed = aggregates.chart_frame(orders(spark, folder), kind, groups, [F.expr(sql) for sql, _ in given])
        framed = rounded(framed, digits, *roles)
        return rounded(framed, 6, "share") if share else framed

    columns = ", ".join(f'round(CAST({sql} AS DOUBLE), {digits}) AS "{role}"' for sql, role in metrics)
    extra = ", round(sum(o_totalprice) / sum(sum(o_totalprice)) OVER (), 6) AS share" if share else ""
    return Entry(run, f"SELECT {', '.join(groups)}, {columns}{extra} FROM orders GROUP BY {', '.join(groups)}")


for _kind, (_groups, _metrics) in _CHARTS.items():
    ENTRIES[f"chart_{_kind}"] = _chart_entry(_kind, _groups, _metrics)


@R.add(
    "chart_world_map",
    """SELECT n_name, round(sum(c_acctbal), 2) AS m1, round(CAST(count(*) AS DOUBLE), 2) AS m2 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def chart_world_map(spark, folder):
    buyers = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    framed = aggregates.chart_frame(buyers, "world_map", ["n_name"], [F.sum("c_acctbal"), F.count(F.lit(1))])
    return rounded(framed, 2, "m1", "m2")


@R.add(
    "bars_by_priority",
    "WITH g AS (SELECT o_orderpriority AS p, o_orderstatus AS s, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2), t AS (SELECT p, sum(v) AS a FROM g GROUP BY 1) SELECT p AS o_orderpriority, "
    + ", ".join(f"""round(sum(v) FILTER (WHERE s = '{s}') / max(a), 6) AS "v, {s}" """ for s in STATUS)
    + ", round(max(a), 2) AS sort_total FROM g JOIN t USING (p) GROUP BY 1",
)
def bars_by_priority(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    bars = pivots.dist_bar(grouped, ["o_orderpriority"], ["o_orderstatus"], ["v"], share=True)
    return rounded(rounded(bars, 6, *[f"v, {s}" for s in STATUS]), 2, "sort_total")


@R.add(
    "radar_scale",
    "SELECT 'v' AS metric, max(v) AS maximum FROM (SELECT round(sum(o_totalprice), 2) AS v FROM orders GROUP BY o_orderpriority) "
    "UNION ALL SELECT 'n', CAST(max(n) AS DOUBLE) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderpriority)",
)
def radar_scale(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority").agg(money(F.sum("o_totalprice")).alias("v"), F.count(F.lit(1)).alias("n"))
    return aggregates.radar_scale(grouped, ["v", "n"])


@R.add(
    "threshold_alerts",
    """SELECT 'revenue' AS rule, round(sum(o_totalprice), 2) AS value, sum(o_totalprice) > 1000 AS fires FROM orders
       UNION ALL SELECT 'no_cancelled', CAST(count(*) FILTER (WHERE o_orderstatus = 'X') AS DOUBLE), count(*) FILTER (WHERE o_orderstatus = 'X') <> 0 FROM orders
       UNION ALL SELECT 'nothing', 0, 0 >= 5 UNION ALL SELECT 'late', CAST(count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1999-01-01') AS DOUBLE), count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1999-01-01') <= 3 FROM orders""",
)
def threshold_alerts(spark, folder):
    rules = {
        "revenue": ("sum(o_totalprice)", ">", 1000),
        "no_cancelled": ("count_if(o_orderstatus = 'X')", "not null"),
        "nothing": ("sum(CASE WHEN o_orderstatus = 'X' THEN 1 END)", ">=", 5),
        "late": ("count_if(o_orderdate >= timestamp_ntz '1999-01-01')", "<=", 3),
    }
    return rounded(aggregates.threshold_alerts(orders(spark, folder), rules), 2, "value")
