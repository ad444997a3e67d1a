"""Aggregations: named aggregates, contribution, roll-ups, chart frames, shop totals.

Roll-ups fold to the finest level first, so grouping sets expand the folded rows, never the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.grains import ntz, time_bucket
from millrace.functions.text import NULL_LABEL
from millrace.operators.filters import generic_type
from millrace.operators.scale import group_quantiles, join_null_safe


def _zero_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


# AG6: operators that are one built-in aggregate. Sums of nothing are 0, as in a data frame.
BUILT_IN = {
    "average": F.avg,
    "mean": F.avg,
    "nanmean": F.avg,
    "count": F.count,
    "count_nonzero": lambda c: F.count_if(c != 0),
    "max": F.max,
    "nanmax": F.max,
    "min": F.min,
    "nanmin": F.min,
    "prod": F.product,
    "product": F.product,
    "std": F.stddev_samp,
    "sum": _zero_sum,
    "nansum": _zero_sum,
    "var": F.var_samp,
    "count_distinct": F.countDistinct,
}
QUANTILE = ("median", "nanmedian", "percentile", "nanpercentile")
POSITION = ("argmin", "argmax")
RUNNING = ("cumsum", "cumprod", "cummax", "cummin")


def _combine(parts: Sequence[DataFrame], groups: Sequence[str]) -> DataFrame:
    """Side-by-side per-group results; the first part has every group."""
    return reduce(lambda a, b: join_null_safe(a, b, groups, "left"), parts)


def _positions(df: DataFrame, groups: Sequence[str], wanted: Mapping[str, tuple[str, str]], order: str) -> DataFrame:
    """Place (0-based, by ``order``) of the first smallest / largest value of each group.

    One aggregate finds the rows, a second pass counts what lies before them: no ordered group
    is ever held by one task. ``order`` is a number, date or timestamp.
    """
    kind = dict(df.dtypes)[order]
    if kind.startswith("timestamp"):
        place = F.timestamp_diff("MICROSECOND", ntz(F.lit("1970-01-01")), ntz(order))
    else:
        place = F.unix_date(order) if kind == "date" else F.col(order)
    df = df.withColumn("__o", place)
    found = []
    for out, (col, op) in wanted.items():
        c, o = F.col(col), F.col("__o")
        known = F.when(c.isNotNull(), o)
        best = F.min_by(known, F.when(c.isNotNull(), F.struct(c, o))) if op == "argmin" else F.max_by(
            known, F.when(c.isNotNull(), F.struct(c, -o))
        )
        found.append(best.alias(f"__at_{out}"))
    first = df.groupBy(*groups).agg(*found)
    placed = join_null_safe(df.select(*groups, "__o"), first, groups, "left")
    return placed.groupBy(*groups).agg(
        *[
            F.when(F.max(f"__at_{out}").isNotNull(), F.count_if(F.col("__o") < F.col(f"__at_{out}"))).alias(out)
            for out in wanted
        ]
    )


def aggregate(
    df: DataFrame,
    groupby: Sequence[str],
    aggs: Mapping[str, tuple | Mapping[str, object]],
    order: str | None = None,
) -> DataFrame:
    """AG6: named aggregates; ``aggs`` maps an output to (column, operator[, options]).

    Without ``groupby`` one row comes back. ``argmin`` / ``argmax`` need the row ``order``.
    """
    groupby = list(groupby)
    plain, extra = [], []
    positions: dict[str, tuple[str, str]] = {}
    quantiles: dict[str, dict[str, tuple[float, str]]] = {}
    if not aggs:
        raise QueryError("no aggregate asked for")
    for out, spec in aggs.items():
        if isinstance(spec, Mapping):
            spec = (spec.get("column", out), spec.get("operator"), spec.get("options") or {})
        col, op = spec[0], spec[1]
        options = dict(spec[2]) if len(spec) > 2 else {}
        if col not in df.columns:
            raise QueryError(f"no such column: {col}")
        if op in ("std", "var") and options.get("ddof") == 0:
            plain.append((F.stddev_pop if op == "std" else F.var_pop)(col).alias(out))
        elif op in BUILT_IN:
            plain.append(BUILT_IN[op](F.col(col)).alias(out))
        elif op in QUANTILE:
            prob = 0.5 if "median" in op else float(options["q"]) / 100
            quantiles.setdefault(col, {})[out] = (prob, options.get("method", "linear"))
        elif op in POSITION:
            if order is None:
                raise QueryError(f"{op} needs the row order")
            positions[out] = (col, op)
        elif op in RUNNING:
            raise QueryError(f"{op} gives one value per row: use cumulative()")
        else:
            raise QueryError(f"unknown aggregate: {op}")
    if positions:
        extra.append(_positions(df, groupby, positions, order))
    extra += [group_quantiles(df, groupby, col, wanted) for col, wanted in quantiles.items()]
    if plain:
        base = df.groupBy(*groupby).agg(*plain)
    elif groupby:
        base = df.select(*groupby).distinct()
    else:
        base, extra = extra[0], extra[1:]
    return _combine([base, *extra], groupby).select(*groupby, *aggs)


def contribution(
    df: DataFrame,
    orientation: str = "column",
    columns: Sequence[str] | None = None,
    rename: Sequence[str] | None = None,
) -> DataFrame:
    """AG12: each cell over its column total (or its row total); nulls count as 0."""
    numeric = [f.name for f in df.schema.fields if generic_type(f.dataType) == "NUMERIC"]
    for name in columns or ():
        if name not in numeric:
            raise QueryError(f"column {name!r} is not numeric or does not exist")
    columns = list(columns or numeric)
    targets = list(rename or columns)
    if len(targets) != len(columns):
        raise QueryError("one new label per column")
    value = {c: F.coalesce(F.col(c), F.lit(0)).cast("double") for c in columns}
    if orientation == "row":
        total = reduce(lambda a, b: a + b, value.values())
        return df.withColumns({t: F.try_divide(value[c], total) for c, t in zip(columns, targets)})
    if orientation != "column":
        raise QueryError(f"unknown orientation: {orientation}")
    # a scalar sub-query, run once: neither a cross join nor a global window
    totals = df.agg(*[F.sum(value[c]).alias(c) for c in columns])
    return df.withColumns(
        {t: F.try_divide(value[c], totals.select(c).scalar()) for c, t in zip(columns, targets)}
    )


def percent_metrics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """AG13: adds ``%metric``."""
    return contribution(df, "column", metrics, [f"%{m}" for m in metrics])


def _level(groups: Sequence[str]) -> Column:
    """How many leading group columns a grouping set kept."""
    return reduce(lambda a, b: a + b, [F.lit(1) - F.grouping(g).cast("bigint") for g in groups]) if groups else F.lit(0)


def rollup_levels(df: DataFrame, groups: Sequence[str], metrics: Sequence[str], op: str = "sum") -> DataFrame:
    """AG14: one result per prefix of the hierarchy, the empty one included."""
    if op not in ("sum", "mean"):
        raise QueryError(f"unknown roll-up: {op}")
    folded = df.groupBy(*groups).agg(
        *[F.sum(m).alias(f"__s_{m}") for m in metrics], *[F.count(m).alias(f"__n_{m}") for m in metrics]
    )
    sums = {m: F.sum(f"__s_{m}") for m in metrics}
    if op == "mean":
        values = [F.try_divide(sums[m].cast("double"), F.sum(f"__n_{m}").cast("double")).alias(m) for m in metrics]
    else:
        values = [F.coalesce(sums[m], F.lit(0)).alias(m) for m in metrics]
    return folded.rollup(*groups).agg(_level(groups).alias("level"), *values)


def rollup_change(df: DataFrame, groups: Sequence[str], time: str, metrics: Sequence[str], kind: str) -> DataFrame:
    """AG15: last time point against the first, at every level; a missing side counts as 0."""
    ends = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    edge = df.where((F.col(time) == lo) | (F.col(time) == hi))
    folded = edge.groupBy(*groups).agg(
        *[F.sum(F.when(F.col(time) == hi, F.col(m))).alias(f"__a_{m}") for m in metrics],
        *[F.sum(F.when(F.col(time) == lo, F.col(m))).alias(f"__b_{m}") for m in metrics],
    )
    out = []
    for m in metrics:
        a = F.coalesce(F.sum(f"__a_{m}"), F.lit(0)).cast("double")
        b = F.coalesce(F.sum(f"__b_{m}"), F.lit(0)).cast("double")
        kinds = {"point_diff": a - b, "point_factor": F.try_divide(a, b), "point_percent": F.try_divide(a, b) - 1}
        if kind not in kinds:
            raise QueryError(f"unknown change: {kind}")
        out.append(kinds[kind].alias(m))
    return folded.rollup(*groups).agg(_level(groups).alias("level"), *out)


def rollup_series(df: DataFrame, groups: Sequence[str], time: str, metrics: Sequence[str]) -> DataFrame:
    """AG16: every level of the hierarchy at every time point."""
    folded = df.groupBy(time, *groups).agg(*[F.sum(m).alias(m) for m in metrics])
    sets = [[time, *groups[:i]] for i in range(len(groups) + 1)]
    return folded.groupingSets(sets, time, *groups).agg(
        _level(groups).alias("level"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in metrics]
    )


def tree_rollup(df: DataFrame, levels: Sequence[str], metric: str, metric2: str | None = None) -> DataFrame:
    """AG17: a node is the sum of its children; a value that is no number counts as 0."""
    second = metric2 or metric
    number = {m: F.coalesce(F.col(m).try_cast("double"), F.lit(0.0)) for m in {metric, second}}
    folded = df.groupBy(*levels).agg(F.sum(number[metric]).alias("__m1"), F.sum(number[second]).alias("__m2"))
    return folded.rollup(*levels).agg(
        _level(levels).alias("depth"), F.sum("__m1").alias("value"), F.sum("__m2").alias("value2")
    )


# Role names of the chart frames and how many metrics each takes (AG22).
CHART_ROLES = {
    "bubble": ("x", "y", "size"),
    "bullet": ("value",),
    "sunburst": ("m1", "m2"),
    "world_map": ("m1", "m2"),
    "parallel": None,
    "dual_line": ("left", "right"),
    "word_cloud": ("size",),
    "pie": ("value",),
    "funnel": ("value",),
    "gauge": ("value",),
}


def chart_frame(df: DataFrame, kind: str, groups: Sequence[str], metrics: Sequence[Column]) -> DataFrame:
    """AG22: a group-by in the shape of a chart; the second of two metrics defaults to the first."""
    if kind not in CHART_ROLES:
        raise QueryError(f"unknown chart: {kind}")
    roles = CHART_ROLES[kind] or tuple(f"m{i + 1}" for i in range(len(metrics)))
    metrics = list(metrics)
    if len(roles) == 2 and len(metrics) == 1:
        metrics *= 2
    if len(metrics) != len(roles):
        raise QueryError(f"{kind} takes {len(roles)} metrics")
    framed = df.groupBy(*groups).agg(*[m.alias(r) for m, r in zip(metrics, roles)])
    return contribution(framed, "column", ["value"], ["share"]) if kind in ("pie", "funnel") else framed


def calendar_cells(df: DataFrame, time: str, subdomain: str, metrics: Mapping[str, Column]) -> DataFrame:
    """AG25: sub-domain buckets as epoch seconds with their values."""
    bucket = time_bucket(time, subdomain)
    cells = df.groupBy(bucket.alias("__b")).agg(*[c.alias(n) for n, c in metrics.items()])
    seconds = F.timestamp_diff("SECOND", ntz(F.lit("1970-01-01")), F.col("__b"))
    return cells.select(seconds.alias("epoch"), *metrics)


def calendar_range(df: DataFrame, time: str, domain: str) -> DataFrame:
    """AG25: number of domain cells the data spans."""
    unit = {"PT1H": "HOUR", "P1D": "DAY", "P1W": "WEEK", "P1M": "MONTH", "P1Y": "YEAR"}[domain]
    ends = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    first, last = time_bucket("lo", domain), time_bucket("hi", domain)
    return ends.select(first.alias("start"), (F.timestamp_diff(unit, first, last) + 1).alias("cells"))


def radar_scale(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """AG33: the largest value per metric, one row each."""
    top = df.agg(*[F.max(m).cast("double").alias(m) for m in metrics])
    return top.unpivot([], list(metrics), "metric", "maximum")


def category_scale(df: DataFrame, x: str, series: str, value: str, threshold: float = 0.0) -> DataFrame:
    """AG42: stack total per x, each cell's share of it, and the label threshold."""
    totals = df.groupBy(x).agg(F.sum(value).alias("stack_total"))
    joined = join_null_safe(df.select(x, series, value), totals, [x], "left")
    return joined.withColumns(
        {
            "share": F.try_divide(F.col(value).cast("double"), F.col("stack_total").cast("double")),
            "threshold": F.lit(threshold) * F.col("stack_total"),
        }
    )


def threshold_alerts(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """AG39: one row per rule with its scalar and whether it fires.

    A rule is (aggregate SQL, operator, threshold) or (aggregate SQL, "not null"); all rules are
    computed in one pass. Empty, null and 0 count as 0.0; "not null" fires on any other value.
    """
    tests = {
        ">": lambda v, t: v > t,
        ">=": lambda v, t: v >= t,
        "<": lambda v, t: v < t,
        "<=": lambda v, t: v <= t,
        "==": lambda v, t: v == t,
        "!=": lambda v, t: v != t,
    }
    facts = df.agg(*[F.expr(rule[0]).cast("double").alias(f"r{i}") for i, rule in enumerate(rules.values())])
    rows = []
    for i, (name, rule) in enumerate(rules.items()):
        value = F.coalesce(F.col(f"r{i}"), F.lit(0.0))
        if rule[1] == "not null":
            fires = value != 0
        elif rule[1] in tests:
            fires = tests[rule[1]](value, F.lit(float(rule[2])))
        else:
            raise QueryError(f"unknown alert operator: {rule[1]}")
        rows.append(F.struct(F.lit(name).alias("rule"), value.alias("value"), fires.alias("fires")))
    return facts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def scalar_alert(result: DataFrame, operator: str, threshold: float = 0.0) -> DataFrame:
    """AG39 over a query result: refuses more than one row or column."""
    if len(result.columns) != 1:
        raise QueryError("an alert query returns one column")
    if len(result.take(2)) > 1:
        raise QueryError("an alert query returns one row")
    named = result.toDF("v")
    return threshold_alerts(named, {"alert": ("max(v)", operator, threshold)})


def stock_balance(opening: DataFrame, lines: DataFrame, product: str, stock: str, line_product: str, quantity: str) -> DataFrame:
    """AG40: opening stock minus everything ordered."""
    ordered = lines.groupBy(F.col(line_product).alias(product)).agg(F.sum(quantity).alias("ordered"))
    joined = opening.select(product, stock).join(ordered, product, "left")
    taken = F.coalesce(F.col("ordered"), F.lit(0.0))
    return joined.select(product, stock, taken.alias("ordered"), (F.col(stock) - taken).alias("balance"))


def null_label(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null labels become ``<NULL>``."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL)) for c in columns})
