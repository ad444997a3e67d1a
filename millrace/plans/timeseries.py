"""Queries of the time-series operators over daily event values, and the shared rounding."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.grains import moment, time_bucket
from millrace.operators import aggregates, ordering, pivots, series
from millrace.operators.query import Dataset, Metric, QuerySpec, run_query
from millrace.plans.base import Entry, Register, daily, rounded, table

R = Register()
ENTRIES = R.entries

# Daily sums of the large events only: rare enough that series lack some days.
_SPARSE = "value IS NOT NULL"
_CELLS = f"""cells AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events
  WHERE {_SPARSE} GROUP BY 1, 2),
axis AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS p FROM (SELECT DISTINCT day FROM cells)),
dense AS (SELECT s.event_type, a.day, a.p, c.v FROM (SELECT DISTINCT event_type FROM cells) s CROSS JOIN axis a
  LEFT JOIN cells c ON c.event_type = s.event_type AND c.day = a.day)"""


def sparse(spark: SparkSession, folder: str) -> DataFrame:
    return daily(table(spark, folder, "events").where(F.expr(_SPARSE)), "event_type")


BY = ["event_type"]


@R.add("densify_events", f"WITH {_CELLS} SELECT event_type, day, round(v, 4) AS v FROM dense")
def densify_events(spark, folder):
    return rounded(series.densify(sparse(spark, folder), BY, "day"), 4, "v")


# kind: (SQL over window w, minimum of known values for an answer beyond min_periods)
ROLLING = {
    "mean": ("avg(v) OVER w", {}),
    "sum": ("sum(v) OVER w", {}),
    "min": ("min(v) OVER w", {}),
    "max": ("max(v) OVER w", {}),
    "count": ("CAST(count(v) OVER w AS DOUBLE)", {}),
    "std": ("stddev_samp(v) OVER w", {}),
    "var": ("var_samp(v) OVER w", {}),
    "median": ("median(v) OVER w", {}),
    "quantile": ("quantile_cont(v, 0.8) OVER w", {"quantile": 0.8}),
    "skew": ("skewness(v) OVER w", {}),
    "kurt": ("kurtosis(v) OVER w", {}),
    "cov": ("covar_samp(v, p) OVER w", {"other": "p"}),
    "corr": ("corr(v, p) OVER w", {"other": "p"}),
}


def _rolling_entry(kind: str, expression: str, options: dict) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        cells = sparse(spark, folder).withColumn("p", F.dayofmonth("day").cast("double"))
        rolled = series.rolling(cells, BY, "day", {"v": "rolled"}, kind, 7, min_periods=4, **options)
        return rounded(rolled, 6, "rolled").select("event_type", "day", "rolled")

    known = "count(*)" if kind == "count" else "count(v)"
    second = "CASE WHEN v IS NOT NULL THEN dayofmonth(day) END"
    sql = f"""WITH {_CELLS}, d AS (SELECT event_type, day, p AS place, v, {second} AS p FROM dense)
SELECT event_type, day, round(CASE WHEN known >= 4 THEN r END, 6) AS rolled FROM (
  SELECT event_type, day, place, {expression} AS r, {known} OVER w AS known FROM d
  WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) WHERE place >= 4"""
    return Entry(run, sql)


for _kind, (_expression, _options) in ROLLING.items():
    ENTRIES[f"rolling7_event_{_kind}"] = _rolling_entry(_kind, _expression, _options)


@R.add(
    "rolling5_centered",
    f"""WITH {_CELLS} SELECT event_type, day, round(CASE WHEN count(v) OVER w >= 1 THEN avg(v) OVER w END, 6) AS rolled FROM dense
        WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""",
)
def rolling5_centered(spark, folder):
    rolled = series.rolling(
        sparse(spark, folder), BY, "day", {"v": "rolled"}, "mean", 5, min_periods=1, center=True, drop_warmup=False
    )
    return rounded(rolled, 6, "rolled").select("event_type", "day", "rolled")


# ---- weighted windows: the weight of row k of 7, oldest first, in SQL ------------------------

WINDOWS = {
    "boxcar": ("1", {}),
    "triang": ("1 - abs(k - 3) / 4", {}),
    "bartlett": ("1 - abs(k - 3) / 3", {}),
    "hann": ("0.5 - 0.5 * cos(2 * pi() * k / 6)", {}),
    "hamming": ("0.54 - 0.46 * cos(2 * pi() * k / 6)", {}),
    "blackman": ("0.42 - 0.5 * cos(2 * pi() * k / 6) + 0.08 * cos(4 * pi() * k / 6)", {}),
    "nuttall": ("0.3635819 - 0.4891775 * cos(2 * pi() * k / 6) + 0.1365995 * cos(4 * pi() * k / 6) - 0.0106411 * cos(6 * pi() * k / 6)", {}),
    "blackmanharris": ("0.35875 - 0.48829 * cos(2 * pi() * k / 6) + 0.14128 * cos(4 * pi() * k / 6) - 0.01168 * cos(6 * pi() * k / 6)", {}),
    "flattop": ("0.21557895 - 0.41663158 * cos(2 * pi() * k / 6) + 0.277263158 * cos(4 * pi() * k / 6) - 0.083578947 * cos(pi() * k) + 0.006947368 * cos(8 * pi() * k / 6)", {}),
    "cosine": ("sin(pi() * (k + 0.5) / 7)", {}),
    "parzen": ("CASE WHEN abs(k - 3) > 7 / 4 THEN 2 * pow(1 - abs(k - 3) / 3.5, 3) ELSE 1 - 6 * pow((k - 3) / 3.5, 2) + 6 * pow(abs(k - 3) / 3.5, 3) END", {}),
    "bohman": ("CASE WHEN k IN (0, 6) THEN 0 ELSE (1 - abs(k - 3) / 3) * cos(pi() * abs(k - 3) / 3) + sin(pi() * abs(k - 3) / 3) / pi() END", {}),
    "gaussian": ("exp(-0.5 * pow((k - 3) / 1.5, 2))", {"std": 1.5}),
    "general_gaussian": ("exp(-0.5 * pow(abs((k - 3) / 2), 3))", {"power": 1.5, "width": 2}),
    "exponential": ("exp(-abs(k - 3) / 2)", {"tau": 2}),
    # Bessel functions by their series: sum of ((x / 2)^j / j!)^2
    "kaiser": (
        "list_sum(list_transform(range(30), lambda j: pow(pow(2.5 * sqrt(1 - pow((k - 3) / 3, 2)), j) / factorial(CAST(j AS INTEGER)), 2)))"
        " / list_sum(list_transform(range(30), lambda j: pow(pow(2.5, j) / factorial(CAST(j AS INTEGER)), 2)))",
        {"beta": 5},
    ),
    "tukey": ("CASE WHEN abs(k - 3) <= 1.5 THEN 1 ELSE 0.5 * (1 - cos(pi() * (1 - abs(k - 3) / 3) / 0.5)) END", {}),
}


def _weighted_entry(name: str, weight: str, options: dict) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        cells, out = sparse(spark, folder), None
        for kind in ("mean", "sum", "std"):
            rolled = series.rolling(cells, BY, "day", {"v": "rolled"}, kind, 7, min_periods=3, win_type=name, win_options=options)
            rolled = rounded(rolled, 7, "rolled").select("event_type", "day", F.lit(kind).alias("kind"), "rolled")
            out = rolled if out is None else out.union(rolled)
        return out

    sql = f"""WITH {_CELLS}, w AS (SELECT k, CAST({weight} AS DOUBLE) AS w FROM (SELECT CAST(unnest(range(7)) AS DOUBLE) AS k)),
j AS (SELECT d.event_type, d.day, d.p, x.v, w.w FROM dense d CROSS JOIN w LEFT JOIN dense x ON x.event_type = d.event_type AND x.p = d.p - 6 + w.k),
m AS (SELECT event_type, day, p, count(v) AS n, sum(v * w) AS s, sum(w) FILTER (v IS NOT NULL) AS w FROM j GROUP BY 1, 2, 3),
a AS (SELECT m.*, (SELECT sum(j.w * pow(j.v - m.s / nullif(m.w, 0), 2)) FROM j WHERE j.event_type = m.event_type AND j.day = m.day) AS apart FROM m WHERE p >= 3)
SELECT event_type, day, kind, round(CASE WHEN n >= 3 THEN CASE kind WHEN 'mean' THEN s / nullif(w, 0) WHEN 'sum' THEN s ELSE sqrt(apart * n / ((n - 1) * w)) END END, 7) AS rolled
FROM a, (SELECT unnest(['mean', 'sum', 'std']) AS kind)"""
    return Entry(run, sql)


for _name, (_weight, _options) in WINDOWS.items():
    ENTRIES[f"rolling7_weighted_{_name}"] = _weighted_entry(_name, _weight, _options)


def _cumulative_entry(op: str, expression: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        cells = sparse(spark, folder).withColumn("v", F.col("v") / 200 if op == "prod" else F.col("v"))
        result = series.cumulative(cells, BY, "day", {"v": "c"}, op)
        if op == "prod":
            result = result.withColumn("c", F.ln("c"))
        return rounded(result, 4, "c").select("event_type", "day", "c")

    return Entry(
        run,
        f"""WITH {_CELLS} SELECT event_type, day, round(CASE WHEN v IS NOT NULL THEN {expression} END, 4) AS c FROM dense
            WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING)""",
    )


for _op, _expression in {
    "sum": "sum(v) OVER w", "min": "min(v) OVER w", "max": "max(v) OVER w", "prod": "ln(product(v / 200) OVER w)",
}.items():
    ENTRIES[f"cum_event_{_op}"] = _cumulative_entry(_op, _expression)


@R.add(
    "diff_event_value",
    f"""WITH {_CELLS} SELECT event_type, day, round(v - lag(v) OVER w, 4) AS back, round(v - lead(v, 2) OVER w, 4) AS ahead FROM dense
        WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
)
def diff_event_value(spark, folder):
    cells = sparse(spark, folder)
    back = series.diff(cells, BY, "day", {"v": "back"}, 1)
    both = series.diff(back, BY, "day", {"v": "ahead"}, -2)
    return rounded(both, 4, "back", "ahead").select("event_type", "day", "back", "ahead")


@R.add(
    "diff_between_columns",
    "SELECT l_orderkey, l_linenumber, l_quantity - NULL AS a, l_tax - l_quantity AS b, l_discount - l_tax AS c FROM lineitem",
)
def diff_between_columns(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("a"), F.col("l_tax").alias("b"), F.col("l_discount").alias("c")
    )
    return series.diff_columns(lines, ["a", "b", "c"])


@R.add(
    "daily_change",
    """WITH d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1)
       SELECT day, round(v - lag(v) OVER (ORDER BY day), 4) AS change FROM d""",
)
def daily_change(spark, folder):
    changed = series.lag_change(daily(table(spark, folder, "events")), "day", "v", "change")
    return rounded(changed, 4, "change").select("day", "change")


@R.add(
    "compare_columns",
    """SELECT o_orderdate, round(f - o, 2) AS "difference__f__o", round_even((f - o) / o, 4) AS "percentage__f__o",
       round_even(f / o, 4) AS "ratio__f__o" FROM (SELECT o_orderdate,
       sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1)""",
)
def compare_columns(spark, folder):
    orders = table(spark, folder, "orders")
    f = F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("f")
    o = F.sum(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice"))).alias("o")
    sides = orders.groupBy("o_orderdate").agg(f, o)
    for kind in ("difference", "percentage", "ratio"):
        sides = series.compare(sides, ["f"], ["o"], kind, drop=kind == "ratio")
    return rounded(sides, 2, "difference__f__o")


# ---- resampling: six-hour cells with gaps, and irregular times -----------------------------

_THIN = "value IS NOT NULL"
_POINTS = f"""points AS (SELECT event_type, date_trunc('hour', ts) AS t, sum(value) AS v FROM events WHERE {_THIN} GROUP BY 1, 2)"""
_GRID6 = """grid AS (SELECT s.event_type, g.t, row_number() OVER (PARTITION BY s.event_type ORDER BY g.t) AS p FROM
  (SELECT DISTINCT event_type FROM points) s CROSS JOIN (SELECT unnest(generate_series(
    (SELECT make_timestamp((epoch_us(min(t)) // 21600000000) * 21600000000) FROM points),
    (SELECT make_timestamp((epoch_us(max(t)) // 21600000000) * 21600000000) FROM points), INTERVAL 6 HOUR)) AS t) g)"""


def points(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where(F.expr(_THIN))
    return events.groupBy("event_type", time_bucket("ts", "PT1H").alias("t")).agg(F.sum("value").alias("v"))


def _resample_entry(method: str, sql: str, fill: float | None = None, digits: int = 4) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = series.resample(points(spark, folder), BY, "t", ["v"], "PT6H", method, fill)
        return rounded(out, digits, "v").select("event_type", "t", "v")

    return Entry(run, sql)


_ASFREQ = f"WITH {_POINTS}, {_GRID6}, j AS (SELECT g.event_type, g.t, g.p, x.v FROM grid g LEFT JOIN points x ON x.event_type = g.event_type AND x.t = g.t)"
ENTRIES["resample_6h_asfreq"] = _resample_entry("asfreq", f"{_ASFREQ} SELECT event_type, t, round(v, 4) AS v FROM j")
ENTRIES["resample_6h_zerofill"] = _resample_entry(
    "asfreq",
    f"""{_ASFREQ} SELECT event_type, t, CASE WHEN t NOT IN (SELECT t FROM points) THEN 0 ELSE round(v, 4) END AS v FROM j""",
    0.0,
)
for _method, _side, _order in (("ffill", "<=", "DESC"), ("bfill", ">=", "ASC")):
    ENTRIES[f"resample_6h_{_method}"] = _resample_entry(
        _method,
        f"""WITH {_POINTS}, {_GRID6}, n AS (SELECT g.event_type, g.t,
              (SELECT x.t FROM points x WHERE x.t {_side} g.t ORDER BY x.t {_order} LIMIT 1) AS near FROM grid g)
            SELECT n.event_type, n.t, round(x.v, 4) AS v FROM n LEFT JOIN points x ON x.event_type = n.event_type AND x.t = n.near""",
    )
ENTRIES["resample_6h_linear"] = _resample_entry(
    "linear",
    f"""{_ASFREQ}, k AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER a AS p0,
          last_value(v IGNORE NULLS) OVER a AS v0, first_value(CASE WHEN v IS NOT NULL THEN p END IGNORE NULLS) OVER b AS p1,
          first_value(v IGNORE NULLS) OVER b AS v1 FROM j
          WINDOW a AS (PARTITION BY event_type ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 b AS (PARTITION BY event_type ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT event_type, t, round(CASE WHEN v IS NOT NULL THEN v WHEN p1 IS NULL THEN v0
          ELSE v0 + (v1 - v0) * (p - p0) / (p1 - p0) END, 6) AS v FROM k""",
    digits=6,
)


def _down_entry(method: str, expression: str) -> Entry:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = series.resample(points(spark, folder), BY, "t", ["v"], "P1D", method)
        return rounded(out, 6, "v").select("event_type", "t", "v")

    return Entry(
        run,
        f"""WITH {_POINTS}, grid AS (SELECT s.event_type, g.t FROM (SELECT DISTINCT event_type FROM points) s CROSS JOIN
              (SELECT unnest(generate_series((SELECT CAST(date_trunc('day', min(t)) AS TIMESTAMP) FROM points),
               (SELECT CAST(date_trunc('day', max(t)) AS TIMESTAMP) FROM points), INTERVAL 1 DAY)) AS t) g),
            b AS (SELECT event_type, CAST(date_trunc('day', t) AS TIMESTAMP) AS t, {expression} AS v FROM points GROUP BY 1, 2)
            SELECT g.event_type, g.t, round({'coalesce(b.v, 0)' if method == 'sum' else 'b.v'}, 6) AS v
            FROM grid g LEFT JOIN b ON b.event_type = g.event_type AND b.t = g.t""",
    )


for _method, _expression in {"sum": "sum(v)", "mean": "avg(v)", "median": "median(v)"}.items():
    ENTRIES[f"resample_1d_{_method}"] = _down_entry(_method, _expression)


# ---- resampling by rules: days of orders by status -------------------------------------------

_ORDER_DAYS = """o AS (SELECT o_orderstatus AS s, CAST(o_orderdate AS TIMESTAMP) AS t, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2),
x AS (SELECT min(t) AS lo, max(t) AS hi FROM o)"""


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.col("o_orderstatus").alias("s"), time_bucket("o_orderdate", "P1D").alias("t")).agg(F.sum("o_totalprice").alias("v"))


def _rule_entry(rule: str, method: str, label: str, cells: str) -> Entry:
    """``label``: the cell of a time t in SQL; ``cells``: all labels from that of x.lo to that of x.hi."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(series.resample(order_days(spark, folder), ["s"], "t", ["v"], rule, method), 4, "v")

    grid = f"g AS (SELECT s, CAST(t AS TIMESTAMP) AS t FROM (SELECT DISTINCT s FROM o) CROSS JOIN (SELECT {cells} AS t FROM x))"
    if method in ("ffill", "bfill"):
        near = ("max", "<=") if method == "ffill" else ("min", ">=")
        sql = f"""n AS (SELECT s, t, (SELECT {near[0]}(o.t) FROM o WHERE o.t {near[1]} g.t) AS near FROM g)
            SELECT n.s, n.t, round(o.v, 4) AS v FROM n LEFT JOIN o ON o.s = n.s AND o.t = n.near"""
    else:
        take = {"sum": "coalesce(sum(v), 0)", "mean": "avg(v)", "median": "median(v)"}[method]
        sql = f"""b AS (SELECT s, CAST({label} AS TIMESTAMP) AS t, v FROM o, x)
            SELECT g.s, g.t, round({take}, 4) AS v FROM g LEFT JOIN b ON b.s = g.s AND b.t = g.t GROUP BY 1, 2"""
    return Entry(run, f"WITH {_ORDER_DAYS}, {grid}, {sql}")


_RULES = {
    "7d": ("7D", "lo + to_days(CAST(date_diff('day', lo, t) // 7 * 7 AS INTEGER))", "unnest(generate_series(lo, hi, INTERVAL 7 DAY))"),
    "week": ("W", "date_trunc('week', t) + INTERVAL 6 DAY", "unnest(generate_series(date_trunc('week', lo), date_trunc('week', hi), INTERVAL 7 DAY)) + INTERVAL 6 DAY"),
    "month_start": ("1MS", "date_trunc('month', t)", "unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH))"),
    "month_end": ("M", "last_day(t)", "last_day(unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)))"),
    "year_start": ("1AS", "date_trunc('year', t)", "unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi), INTERVAL 1 YEAR))"),
    "year_end": ("A", "make_date(CAST(year(t) AS INTEGER), 12, 31)", "make_date(CAST(unnest(range(year(lo), year(hi) + 1)) AS INTEGER), 12, 31)"),
}
for _key, _method in (
    ("7d", "sum"), ("7d", "median"), ("week", "mean"), ("month_start", "mean"), ("month_start", "bfill"),
    ("month_end", "sum"), ("month_end", "median"), ("month_end", "ffill"), ("year_start", "sum"), ("year_end", "median"), ("year_end", "sum"),
):
    ENTRIES[f"resample_{_key}_{_method}"] = _rule_entry(_RULES[_key][0], _method, *_RULES[_key][1:])


# ---- the axis at the grain of seconds ------------------------------------------------------

_SECONDS = """cells AS (SELECT event_type, date_trunc('second', ts) AS t, sum(value) AS v FROM events GROUP BY 1, 2),
dense AS (SELECT s.event_type, a.t, c.v FROM (SELECT DISTINCT event_type FROM cells) s CROSS JOIN (SELECT DISTINCT t FROM cells) a
  LEFT JOIN cells c ON c.event_type = s.event_type AND c.t = a.t)"""


def by_second(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("event_type", time_bucket("ts", "PT1S").alias("t")).agg(F.sum("value").alias("v"))


@R.add("densify_seconds", f"WITH {_SECONDS} SELECT event_type, t, round(v, 4) AS v FROM dense")
def densify_seconds(spark, folder):
    return rounded(series.densify(by_second(spark, folder), BY, "t"), 4, "v")


@R.add(
    "rolling60_seconds",
    f"""WITH {_SECONDS} SELECT event_type, t, round(CASE WHEN count(v) OVER w >= 1 THEN avg(v) OVER w END, 6) AS rolled FROM dense
        WINDOW w AS (PARTITION BY event_type ORDER BY t ROWS 59 PRECEDING)""",
)
def rolling60_seconds(spark, folder):
    rolled = series.rolling(by_second(spark, folder), BY, "t", {"v": "rolled"}, "mean", 60, min_periods=1, drop_warmup=False)
    return rounded(rolled, 6, "rolled").select("event_type", "t", "rolled")


@R.add(
    "cum_own_seconds",
    f"""WITH {_SECONDS} SELECT event_type, t, round(sum(v) OVER (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING), 4) AS c FROM cells""",
)
def cum_own_seconds(spark, folder):
    """Without the shared axis: each series keeps its own rows."""
    return rounded(series.cumulative(by_second(spark, folder), BY, "t", {"v": "c"}, "sum", dense=False), 4, "c").select("event_type", "t", "c")


@R.add(
    "align_two_series",
    f"""WITH a AS (SELECT date_trunc('second', ts) AS t, sum(value) AS v FROM events WHERE event_type = 'click' GROUP BY 1),
       b AS (SELECT date_trunc('second', ts) AS t, sum(value) AS v FROM events WHERE event_type = 'view' GROUP BY 1),
       l AS (SELECT a.t, a.v, b.t AS t0 FROM a ASOF LEFT JOIN b ON a.t >= b.t), n AS (SELECT l.*, b.t AS t1 FROM l ASOF LEFT JOIN b ON l.t <= b.t)
       SELECT n.t, round(n.v, 4) AS v, round(CASE WHEN n.t1 IS NULL THEN x.v WHEN n.t0 = n.t1 THEN x.v
         ELSE x.v + (y.v - x.v) * (epoch_us(n.t) - epoch_us(n.t0)) / (epoch_us(n.t1) - epoch_us(n.t0)) END, 6) AS v__other
       FROM n LEFT JOIN b x ON x.t = n.t0 LEFT JOIN b y ON y.t = n.t1""",
)
def align_two_series(spark, folder):
    """Clicks and views by the second: most seconds of one have no value of the other."""
    events = table(spark, folder, "events")
    clicks = events.where("event_type = 'click'").groupBy(time_bucket("ts", "PT1S").alias("t"))
    views = events.where("event_type = 'view'").groupBy(time_bucket("ts", "PT1S").alias("t"))
    aligned = series.align_series(clicks.agg(F.sum("value").alias("v")), views.agg(F.sum("value").alias("v")), "t", "v")
    return rounded(rounded(aligned, 4, "v"), 6, "v__other")


@R.add(
    "shifted_week_compare",
    """WITH d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1),
       now AS (SELECT * FROM d WHERE day >= TIMESTAMP '2024-01-15'), past AS (SELECT day + INTERVAL 7 DAY AS day, v FROM d WHERE day < TIMESTAMP '2024-01-20')
       SELECT now.day, round((now.v - past.v) / past.v, 4) AS change FROM now JOIN past USING (day)
       UNION ALL SELECT now.day, round((now.v - l.v) / l.v, 4) FROM now, (SELECT v FROM past ORDER BY day DESC LIMIT 1) l
       WHERE now.day > (SELECT max(day) FROM past)""",
)
def shifted_week_compare(spark, folder):
    days = daily(table(spark, folder, "events"))
    now = days.where(F.col("day") >= moment(datetime(2024, 1, 15)))
    past = days.where(F.col("day") < moment(datetime(2024, 1, 20)))
    return rounded(series.time_compare(now, past, "day", "v", "day", 7, "percentage"), 4, "change")


@R.add(
    "period_overlay_weeks",
    """WITH d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1),
       w AS (SELECT *, CAST(date_trunc('week', day) AS TIMESTAMP) AS a FROM d), r AS (SELECT *, dense_rank() OVER (ORDER BY a DESC) - 1 AS rank FROM w),
       m AS (SELECT max(a) AS ma, max(rank) AS mr FROM r)
       SELECT day + (ma - a) AS day, CASE WHEN rank = 0 THEN 'current' ELSE '-' || rank END AS series, rank,
         round(v, 4) AS v, round(1 - rank / (mr + 1), 4) AS perc FROM r, m""",
)
def period_overlay_weeks(spark, folder):
    laid = series.period_overlay(daily(table(spark, folder, "events")), "day", "v", "week")
    return rounded(laid, 4, "v", "perc")


@R.add(
    "trend_headline",
    f"""WITH {_CELLS}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS n FROM cells)
        SELECT a.event_type, round(a.v, 4) AS headline, a.day AS headline_time, round((a.v - b.v) / abs(b.v), 4) AS change
        FROM r a LEFT JOIN r b ON a.event_type = b.event_type AND b.n = 8 WHERE a.n = 1""",
)
def trend_headline(spark, folder):
    return rounded(series.trend_headline(sparse(spark, folder), "day", "v", 7, BY), 4, "headline", "change")


@R.add(
    "fill_beside_known",
    f"""WITH {_CELLS} SELECT event_type, day, CASE WHEN v IS NULL AND (lag(v) OVER w IS NOT NULL OR lead(v) OVER w IS NOT NULL)
        THEN 0 ELSE round(v, 4) END AS v FROM dense WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
)
def fill_beside_known(spark, folder):
    return rounded(series.fill_neighbor(sparse(spark, folder), BY, "day", "v", 0.0), 4, "v")


@R.add(
    "chart_chain",
    f"""WITH {_CELLS}, r AS (SELECT event_type, day, sum(v) OVER (PARTITION BY event_type ORDER BY day ROWS 2 PRECEDING) AS v FROM dense)
        SELECT event_type, day, round(coalesce(v, 0) / sum(coalesce(v, 0)) OVER (PARTITION BY day), 4) AS v FROM r""",
)
def chart_chain(spark, folder):
    """WN12: pivot axis, rolling sum, then each day's share per type."""
    chain = series.series_frame(
        sparse(spark, folder), BY, "day", "v", rolling_kind="sum", window=3, min_periods=0, contribution="row"
    )
    return rounded(chain, 4, "v")


@R.add(
    "query_post_processing",
    """WITH d AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS __timestamp, event_type, sum(value) AS v FROM events GROUP BY 1, 2)
       SELECT __timestamp, event_type, round(sum(v) OVER (PARTITION BY event_type ORDER BY __timestamp ROWS UNBOUNDED PRECEDING), 4) AS v FROM d""",
)
def query_post_processing(spark, folder):
    spec = QuerySpec(
        Dataset(table(spark, folder, "events"), time_col="ts"), columns=["event_type"], metrics=[Metric("v", "value", "SUM")],
        is_timeseries=True, grain="P1D",
        post_processing=[
            ("cum", {"series": BY, "time": "__timestamp", "columns": {"v": "v"}, "op": "sum"}),
            ("sort", {"by": ["__timestamp", "event_type"]}),
        ],
    )
    return rounded(run_query(spec), 4, "v")


_Z80 = 1.2815515655446004
_FORECAST = f"""WITH d AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1, 2),
x AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) - 1 AS p FROM d),
l AS (SELECT event_type, regr_slope(v, p) AS b, regr_intercept(v, p) AS a, max(p) AS e, max(day) AS last FROM x GROUP BY 1),
f AS (SELECT x.*, a + b * p AS line, p % 7 AS place FROM x JOIN l USING (event_type)),
s AS (SELECT event_type, place, avg(v - line) AS s FROM f GROUP BY 1, 2),
y AS (SELECT f.event_type, day, v, line + s AS yhat FROM f JOIN s USING (event_type, place)),
sd AS (SELECT event_type, stddev_samp(v - yhat) AS sd FROM y GROUP BY 1),
h AS (SELECT l.event_type, last + to_days(CAST(k AS INTEGER)) AS day, CAST(NULL AS DOUBLE) AS v, a + b * (e + k) + s AS yhat
      FROM l, generate_series(1, 14) g(k) JOIN s ON s.event_type = l.event_type AND s.place = (e + k) % 7),
u AS (SELECT * FROM y UNION ALL SELECT * FROM h)
SELECT u.event_type, day, round(v, 4) AS v, round(yhat, 4) AS __yhat, round(yhat - {_Z80} * sd, 4) AS __yhat_lower,
  round(yhat + {_Z80} * sd, 4) AS __yhat_upper FROM u JOIN sd ON sd.event_type = u.event_type"""


@R.add("forecast_event_value", _FORECAST)
def forecast_event_value(spark, folder):
    result = series.forecast(daily(table(spark, folder, "events"), "event_type"), BY, "day", "v", 14, "P1D", 0.8, season=7)
    return rounded(result, 4, "v", "__yhat", "__yhat_lower", "__yhat_upper")


@R.add(
    "event_paths_len3",
    """WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
       p AS (SELECT user_id, max(CASE WHEN n = 1 THEN event_type END) AS a, max(CASE WHEN n = 2 THEN event_type END) AS b,
             max(CASE WHEN n = 3 THEN event_type END) AS c FROM r WHERE n <= 3 GROUP BY 1),
       u AS (SELECT 1 AS depth, a AS path FROM p UNION ALL SELECT 2, a || ' > ' || b FROM p WHERE b IS NOT NULL
             UNION ALL SELECT 3, a || ' > ' || b || ' > ' || c FROM p WHERE c IS NOT NULL)
       SELECT depth, path, count(*) AS entities FROM u GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def event_paths_len3(spark, folder):
    return series.event_paths(table(spark, folder, "events"), "user_id", "event_type", ["ts", "event_id"], 3, 2)


@R.add(
    "time_table",
    """SELECT day, round(avg(v) FILTER (WHERE event_type = 'click'), 4) AS click, round(avg(v) FILTER (WHERE event_type = 'error'), 4) AS error,
       round(avg(v) FILTER (WHERE event_type = 'purchase'), 4) AS purchase, round(avg(v) FILTER (WHERE event_type = 'signup'), 4) AS signup,
       round(avg(v) FILTER (WHERE event_type = 'view'), 4) AS view FROM (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type,
       sum(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def time_table(spark, folder):
    wide = pivots.time_table(daily(table(spark, folder, "events"), "event_type"), "day", ["v"], BY)
    return rounded(wide, 4, *[c for c in wide.columns if c != "day"])


@R.add(
    "calendar_cells",
    """SELECT CAST(epoch_us(date_trunc('hour', ts)) // 1000000 AS BIGINT) AS epoch, round(sum(value), 4) AS v, count(*) AS n FROM events GROUP BY 1""",
)
def calendar_cells(spark, folder):
    cells = aggregates.calendar_cells(
        table(spark, folder, "events"), "ts", "PT1H", {"v": F.sum("value"), "n": F.count(F.lit(1))}
    )
    return rounded(cells, 4, "v")


@R.add(
    "calendar_range",
    "SELECT CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP) AS start, date_diff('month', min(o_orderdate), max(o_orderdate)) + 1 AS cells FROM orders",
)
def calendar_range(spark, folder):
    return aggregates.calendar_range(table(spark, folder, "orders"), "o_orderdate", "P1M")


@R.add(
    "series_by_total",
    """WITH d AS (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, sum(value) AS v FROM events GROUP BY 1, 2)
       SELECT event_type, day, round(v, 4) AS v, round(sum(v) OVER (PARTITION BY event_type), 4) AS series_key FROM d""",
)
def series_by_total(spark, folder):
    ordered = ordering.order_series(daily(table(spark, folder, "events"), "event_type"), BY, "day", "v", "sum", False)
    return rounded(ordered, 4, "v", "series_key")


@R.add(
    "union_of_charts",
    """SELECT 'sales' AS chart, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS t, round(sum(o_totalprice), 2) AS v,
         (SELECT least((SELECT CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP) FROM orders), (SELECT CAST(date_trunc('month', min(l_shipdate)) AS TIMESTAMP) FROM lineitem))) AS x_min
       FROM orders GROUP BY 1, 2
       UNION ALL SELECT 'shipped', CAST(date_trunc('month', l_shipdate) AS TIMESTAMP), round(sum(l_extendedprice), 2),
         (SELECT least((SELECT CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP) FROM orders), (SELECT CAST(date_trunc('month', min(l_shipdate)) AS TIMESTAMP) FROM lineitem)))
       FROM lineitem GROUP BY 1, 2""",
)
def union_of_charts(spark, folder):
    def monthly(name: str, time: str, value: str) -> DataFrame:
        frame = table(spark, folder, name)
        return frame.groupBy(time_bucket(time, "P1M").alias("t")).agg(F.sum(value).alias("v"))

    union, extent = ordering.union_series(
        {"sales": monthly("orders", "o_orderdate", "o_totalprice"), "shipped": monthly("lineitem", "l_shipdate", "l_extendedprice")},
        "t", "v",
    )
    return rounded(union.withColumn("x_min", extent.select("x_min").scalar()), 2, "v")
