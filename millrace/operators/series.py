"""Time-series operators (WN2-WN15, J11) on the long form: series columns, time, values.

Input frames hold one row per (series, time bucket): grouping by bucket comes first, so a series
holding a third of the raw rows is already folded to at most one row per bucket. ``densify`` then
gives every series the shared time axis (``axis``) and its position on it. Windows run over pieces of
``CHUNK`` positions: bounded frames carry a small overlap into the neighbouring piece, running
values carry one aggregate per piece, so no window holds a whole long series in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.grains import CALENDAR_GRAINS, SECOND_GRAINS, WEEK_GRAINS, ntz, shift, truncate
from millrace.operators.axis import POS, micros, observed_axis, on_axis, rule_of
from millrace.operators.kernels import kernel
from millrace.operators.scale import group_quantiles, join_null_safe, numbered
from millrace.session import cut_lineage

CHUNK = 100_000


def densify(df: DataFrame, series: Sequence[str], time: str, position: bool = False) -> DataFrame:
    """WN15: every observed series at every observed time; missing cells are null.

    The folded frame is settled once: axis, series and cells all read it.
    """
    df = cut_lineage(df)
    grid = on_axis(df, series, observed_axis(df, time))
    dense = join_null_safe(grid, df, [*series, time], "left")
    return dense if position else dense.drop(POS)


def _own_rows(df: DataFrame, series: Sequence[str], time: str) -> DataFrame:
    """The rows with a time, each with its place among the rows of its series."""
    placed = numbered(df.where(F.col(time).isNotNull()), [*series, time], "__place")
    if not series:
        return placed.withColumnRenamed("__place", POS)
    first = placed.groupBy(*series).agg(F.min("__place").alias("__first"))
    placed = join_null_safe(placed, first, series, "inner")
    return placed.select(*df.columns, (F.col("__place") - F.col("__first")).alias(POS))


def _positioned(df: DataFrame, series: Sequence[str], time: str, dense: bool) -> DataFrame:
    return densify(df, series, time, position=True) if dense else _own_rows(df, series, time)


def _near(
    df: DataFrame, series: Sequence[str], before: int, after: int, outputs: Callable[[object], dict[str, Column]]
) -> DataFrame:
    """Row-frame windows reaching ``before`` rows back and ``after`` ahead, piece by piece."""
    size = max(CHUNK, 2 * (before + after))
    home = F.floor(F.col(POS) / size)
    offset = F.pmod(F.col(POS), F.lit(size))
    visits = F.array_compact(
        F.array(
            home,
            F.when(offset >= size - before, home + 1) if before else F.lit(None).cast("bigint"),
            F.when(offset < after, home - 1) if after else F.lit(None).cast("bigint"),
        )
    )
    pieces = df.withColumn("__piece", F.explode(visits))
    window = W.partitionBy(*series, "__piece").orderBy(POS)
    return pieces.withColumns(outputs(window)).where(F.col("__piece") == home).drop("__piece")


# How a running value is taken inside a piece, folded per piece, and carried over.
_RUNNING = {
    "sum": (F.sum, F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "prod": (F.product, F.product, lambda a, b: F.coalesce(a * b, a, b)),
    "min": (F.min, F.min, F.least),
    "max": (F.max, F.max, F.greatest),
}


def running(
    df: DataFrame, series: Sequence[str], wanted: Mapping[str, tuple[str, str]], backwards: bool = False
) -> DataFrame:
    """Running values up to and including each row, ignoring nulls.

    ``wanted`` maps an output to (op, column) with op in sum, prod, min, max, last.
    """
    pieces = df.withColumn("__piece", F.floor(F.col(POS) / CHUNK))
    direction = (lambda c: F.col(c).desc()) if backwards else (lambda c: F.col(c).asc())
    inside = (
        W.partitionBy(*series, "__piece").orderBy(direction(POS)).rowsBetween(W.unboundedPreceding, 0)
    )
    earlier = (
        W.partitionBy(*(series or [F.lit(0)]))
        .orderBy(direction("__piece"))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    folded, carried, local, combined = [], [], {}, {}
    for out, (op, col) in wanted.items():
        if op == "last":
            place = -F.col(POS) if backwards else F.col(POS)
            known = F.when(F.col(col).isNotNull(), place)
            folded.append(F.max_by(F.col(col), known).alias(f"__f_{out}"))
            carried.append(F.last(f"__f_{out}", ignorenulls=True).over(earlier).alias(f"__c_{out}"))
            local[f"__l_{out}"] = F.last(F.col(col), ignorenulls=True).over(inside)
            combined[out] = F.coalesce(F.col(f"__l_{out}"), F.col(f"__c_{out}"))
        else:
            if op not in _RUNNING:
                raise QueryError(f"unknown running value: {op}")
            windowed, fold, combine = _RUNNING[op]
            folded.append(fold(col).alias(f"__f_{out}"))
            carried.append(fold(f"__f_{out}").over(earlier).alias(f"__c_{out}"))
            local[f"__l_{out}"] = windowed(col).over(inside)
            combined[out] = combine(F.col(f"__l_{out}"), F.col(f"__c_{out}"))
    per_piece = pieces.groupBy(*series, "__piece").agg(*folded).select(*series, "__piece", *carried)
    joined = join_null_safe(pieces.withColumns(local), per_piece, [*series, "__piece"], "left")
    extra = [f"__{k}_{out}" for out in wanted for k in ("l", "c")]
    return joined.withColumns(combined).drop("__piece", *extra)


ROLLING_KINDS = (
    "count", "corr", "cov", "kurt", "max", "mean", "median", "min", "quantile", "skew", "std", "sum", "var",
)


def _rolled(kind: str, col: str, frame, other: str | None, prob: float | None) -> Column:
    x = F.col(col)
    n = F.count(x).over(frame)
    if kind == "count":
        return n.cast("double")
    if kind == "sum":
        return F.coalesce(F.sum(x).over(frame), F.lit(0.0))
    if kind in ("mean", "min", "max"):
        return {"mean": F.avg, "min": F.min, "max": F.max}[kind](x).over(frame)
    if kind == "median":
        return F.percentile(x, F.lit(0.5)).over(frame)
    if kind == "quantile":
        if prob is None:
            raise QueryError("a rolling quantile needs its probability")
        return F.percentile(x, F.lit(float(prob))).over(frame)
    if kind == "std":
        return F.stddev_samp(x).over(frame)
    if kind == "var":
        return F.var_samp(x).over(frame)
    if kind == "skew":
        factor = F.try_divide(F.sqrt((n * (n - 1)).cast("double")), (n - 2).cast("double"))
        return F.when(n >= 3, F.skewness(x).over(frame) * factor)
    if kind == "kurt":
        g = F.kurtosis(x).over(frame)
        factor = F.try_divide((n - 1).cast("double"), ((n - 2) * (n - 3)).cast("double"))
        return F.when(n >= 4, factor * ((n + 1) * g + 6))
    pair = F.col(other or col)
    return (F.corr(x, pair) if kind == "corr" else F.covar_samp(x, pair)).over(frame)


WEIGHTED_KINDS = ("mean", "std", "sum", "var")


def _weighted(kind: str, rows: str, behind: int, weights: Sequence[float]) -> Column:
    """Moving value over (place, value) rows, each weighted by its place in the window; nulls carry no weight."""
    table = F.array(*[F.lit(float(w)) for w in weights])
    zero = F.lit(0.0)
    known = F.transform(
        F.filter(rows, lambda r: r["v"].isNotNull()),
        lambda r: F.struct(r["v"].alias("v"), F.get(table, (r["p"] - F.col(POS) + F.lit(behind)).cast("int")).alias("w")),
    )
    totals = F.aggregate(
        known, F.struct(zero.alias("w"), zero.alias("s")),
        lambda a, r: F.struct((a["w"] + r["w"]).alias("w"), (a["s"] + r["w"] * r["v"]).alias("s")),
    )
    if kind == "sum":
        return totals["s"]
    mean = F.try_divide(totals["s"], totals["w"])
    if kind == "mean":
        return mean
    n = F.size(known).cast("double")
    apart = F.aggregate(known, zero, lambda a, r: a + r["w"] * (r["v"] - mean) * (r["v"] - mean))
    spread = F.when(n > 1, F.try_divide(apart * n, (n - 1) * totals["w"]))
    return F.sqrt(spread) if kind == "std" else spread


def rolling(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    columns: Mapping[str, str],
    kind: str,
    window: int,
    min_periods: int | None = None,
    center: bool = False,
    quantile: float | None = None,
    other: str | None = None,
    dense: bool = True,
    drop_warmup: bool = True,
    win_type: str | None = None,
    win_options: Mapping[str, float] | None = None,
) -> DataFrame:
    """WN3: moving aggregates over ``window`` rows ending at (or centred on) each row.

    Fewer than ``min_periods`` (default: the window) known values give null. When ``min_periods``
    is given and not 0, the first that many time points are dropped. With ``win_type`` the rows of
    a window are weighted (``kernels``) in a mean, sum, variance or standard deviation.
    """
    if not window:
        raise QueryError("a rolling window needs a size above 0")
    if kind not in (WEIGHTED_KINDS if win_type else ROLLING_KINDS):
        raise QueryError(f"unknown rolling kind: {kind}")
    weights = kernel(win_type, window, **(win_options or {})) if win_type else None
    needed = window if min_periods is None else min_periods
    ahead = (window - 1) // 2 if center else 0
    behind = window - 1 - ahead
    placed = _positioned(df, series, time, dense)

    def outputs(order) -> dict[str, Column]:
        frame = order.rowsBetween(-behind, ahead)
        out = {}
        for source, target in columns.items():
            known = F.count(F.lit(1) if kind == "count" else F.col(source)).over(frame)
            if weights:
                out[f"__enough_{target}"] = known >= needed
                cells = F.struct(F.col(POS).alias("p"), F.col(source).cast("double").alias("v"))
                out[f"__rows_{target}"] = F.collect_list(cells).over(frame)  # at most ``window`` rows
            else:
                out[target] = F.when(known >= needed, _rolled(kind, source, frame, other, quantile))
        return out

    result = _near(placed, series, behind, ahead, outputs)
    if weights:
        values = {t: F.when(F.col(f"__enough_{t}"), _weighted(kind, f"__rows_{t}", behind, weights)) for t in columns.values()}
        result = result.withColumns(values).drop(*[f"__{part}_{t}" for t in columns.values() for part in ("enough", "rows")])
    if min_periods and drop_warmup:
        result = result.where(F.col(POS) >= min_periods)
    return result.drop(POS)


def cumulative(
    df: DataFrame, series: Sequence[str], time: str, columns: Mapping[str, str], op: str, dense: bool = True
) -> DataFrame:
    """WN4: running sum, prod, min or max; a null stays null and the value goes on after it."""
    if op not in _RUNNING:
        raise QueryError(f"unknown cumulative operator: {op}")
    placed = _positioned(df, series, time, dense)
    temp = {f"__r_{t}": (op, s) for s, t in columns.items()}
    result = running(placed, series, temp)
    result = result.withColumns({f"__o_{t}": F.when(F.col(s).isNotNull(), F.col(f"__r_{t}")) for s, t in columns.items()})
    result = result.withColumns({t: F.col(f"__o_{t}") for t in columns.values()})
    return result.drop(POS, *[f"__{k}_{t}" for t in columns.values() for k in "ro"])


def diff(
    df: DataFrame, series: Sequence[str], time: str, columns: Mapping[str, str], periods: int = 1, dense: bool = True
) -> DataFrame:
    """WN5: value minus the value ``periods`` rows earlier (negative: later)."""
    placed = _positioned(df, series, time, dense)

    def outputs(order) -> dict[str, Column]:
        return {t: F.col(s) - F.lag(s, periods).over(order) for s, t in columns.items()}

    return _near(placed, series, max(periods, 0), max(-periods, 0), outputs).drop(POS)


def diff_columns(df: DataFrame, columns: Sequence[str], periods: int = 1) -> DataFrame:
    """WN5 across columns: each column minus the one ``periods`` places to its left."""
    out = {}
    for i, name in enumerate(columns):
        j = i - periods
        out[name] = F.col(name) - F.col(columns[j]) if 0 <= j < len(columns) else F.lit(None).cast("double")
    return df.withColumns(out)


def lag_change(df: DataFrame, time: str, value: str, target: str, series: Sequence[str] = ()) -> DataFrame:
    """WN2: change against the previous row."""
    return diff(df, series, time, {value: target}, 1, dense=True)


def compare(
    df: DataFrame,
    sources: Sequence[str],
    others: Sequence[str],
    kind: str,
    drop: bool = False,
    precision: int = 4,
) -> DataFrame:
    """WN6: column pairs as difference, percentage or ratio, named ``kind__source__other``."""
    if len(sources) != len(others):
        raise QueryError("compare needs as many columns on both sides")
    if kind not in ("difference", "percentage", "ratio"):
        raise QueryError(f"unknown comparison: {kind}")
    out = {}
    for s, c in zip(sources, others):
        left, right = F.col(s).cast("double"), F.col(c).cast("double")
        if kind == "difference":
            value = F.col(s) - F.col(c)
        elif kind == "percentage":
            value = F.bround(F.try_divide(left - right, right), precision)
        else:
            value = F.bround(F.try_divide(left, right), precision)
        out[f"{kind}__{s}__{c}"] = value
    df = df.withColumns(out) if out else df
    return df.drop(*sources, *others) if drop and out else df


def grain_step(grain: str) -> tuple[str, int]:
    """The distance between neighbouring buckets as (unit, amount)."""
    if grain in CALENDAR_GRAINS:
        return CALENDAR_GRAINS[grain], 1
    if grain in SECOND_GRAINS:
        return "second", SECOND_GRAINS[grain]
    if grain in WEEK_GRAINS:
        return "week", 1
    raise QueryError(f"unknown time grain: {grain}")


RESAMPLE_METHODS = ("asfreq", "bfill", "ffill", "linear", "mean", "median", "sum")


def _nearest_times(times: DataFrame, cells: DataFrame, time: str, backwards: bool) -> DataFrame:
    """(place, time, __near) of each cell: the last observed time up to it, or the first from it on."""
    marked = times.select(time, F.col(time).alias("__seen"), F.lit(None).cast("bigint").alias("__cell"))
    marked = marked.unionByName(cells.select(time, F.lit(None).cast(dict(times.dtypes)[time]).alias("__seen"), F.col(POS).alias("__cell")))
    both = marked.groupBy(time).agg(F.max("__seen").alias("__seen"), F.max("__cell").alias("__cell"))
    found = running(numbered(both, [time], POS), [], {"__near": ("last", "__seen")}, backwards)
    return found.where(F.col("__cell").isNotNull()).select(F.col("__cell").alias(POS), time, "__near")


def resample(
    df: DataFrame, series: Sequence[str], time: str, columns: Sequence[str], grain: str, method: str, fill: float | None = None
) -> DataFrame:
    """WN7: values on a regular grid from the first to the last cell of the whole frame.

    ``grain`` is a time grain or a rule such as ``7D``, ``1MS`` or ``1M`` (``axis.rule_of``).
    """
    if method not in RESAMPLE_METHODS:
        raise QueryError(f"resample method should be one of {', '.join(RESAMPLE_METHODS)}")
    df = cut_lineage(df)
    grid = rule_of(grain).over(df, time)
    axis = grid.axis(df.sparkSession, time)
    if method in ("mean", "median", "sum"):
        bins = df.where(F.col(time).isNotNull()).withColumn(time, grid.label(grid.place(time)))
        if method == "median":
            cells = on_axis(df, series, axis).drop(POS)
            for c in columns:
                middle = group_quantiles(bins.select(*series, time, c), [*series, time], c, {c: (0.5, "linear")})
                cells = join_null_safe(cells, middle, [*series, time], "left")
            return cells
        take = {"mean": F.avg, "sum": F.sum}[method]
        bins = bins.groupBy(*series, time).agg(*[take(c).alias(c) for c in columns])
        out = join_null_safe(on_axis(df, series, axis).drop(POS), bins, [*series, time], "left")
        return out.fillna(0, subset=list(columns)) if method == "sum" else out
    if method in ("asfreq", "linear"):
        out = join_null_safe(on_axis(df, series, axis), df.select(*series, time, *columns), [*series, time], "left")
        if method == "asfreq":
            if fill is not None:
                # only grid points the frame has at no series are filled; known nulls stay
                times = df.select(time, F.lit(True).alias("__real")).distinct()
                out = join_null_safe(out, times, [time], "left")
                out = out.withColumns(
                    {c: F.when(F.col("__real").isNull(), F.lit(fill)).otherwise(F.col(c)) for c in columns}
                ).drop("__real")
            return out.drop(POS)
        return _interpolated(out, series, columns, F.col(POS)).drop(POS)
    # ffill / bfill: the nearest observed time point decides, even when its cell is null
    times = df.select(time).where(F.col(time).isNotNull()).distinct()
    placed = on_axis(df, series, _nearest_times(times, axis, time, method == "bfill"))
    cells = df.select(*series, F.col(time).alias("__near"), *columns)
    return join_null_safe(placed, cells, [*series, "__near"], "left").select(*series, time, *columns)


def _interpolated(placed: DataFrame, series: Sequence[str], columns: Sequence[str], place: Column) -> DataFrame:
    """Nulls between two known values on a straight line over ``place``; after the last, its value."""
    names = placed.columns
    placed = placed.withColumns(
        {f"__k_{c}": F.when(F.col(c).isNotNull(), F.struct(place.alias("p"), F.col(c).cast("double").alias("v"))) for c in columns}
    )
    placed = running(placed, series, {f"__a_{c}": ("last", f"__k_{c}") for c in columns})
    placed = running(placed, series, {f"__b_{c}": ("last", f"__k_{c}") for c in columns}, backwards=True)
    out = []
    for name in names:
        if name not in columns:
            out.append(F.col(name))
            continue
        a, b = F.col(f"__a_{name}"), F.col(f"__b_{name}")
        share = F.try_divide((place - a["p"]).cast("double"), (b["p"] - a["p"]).cast("double"))
        line = a["v"] + (b["v"] - a["v"]) * share
        out.append(F.coalesce(F.col(name).cast("double"), F.when(b.isNull(), a["v"]).otherwise(line)).alias(name))
    return placed.select(*out)


def align_series(a: DataFrame, b: DataFrame, time: str, value: str, series: Sequence[str] = ()) -> DataFrame:
    """J11: ``b`` linearly interpolated by time onto ``a``'s time axis, per series.

    An as-of merge: the rows of both are dealt into ranges of (series, time); in pieces of them each row finds the last
    and first known value of ``b``, and pieces hand theirs on as one row each.
    """
    left = a.select(*series, time, F.col(value).alias("__av"), F.lit(True).alias("__mine"))
    right = b.select(*series, time, F.col(value).alias("__bv"))
    union = left.unionByName(right, allowMissingColumns=True)
    cells = union.groupBy(*series, time).agg(
        F.max("__av").alias(value), F.max("__bv").alias(f"{value}__other"), F.max("__mine").alias("__mine")
    )
    placed = numbered(cells.where(F.col(time).isNotNull()), [*series, time], POS)
    filled = _interpolated(placed, series, [f"{value}__other"], micros(time))
    return filled.where("__mine").select(*series, time, value, f"{value}__other")


def time_compare(
    now: DataFrame, past: DataFrame, time: str, value: str, unit: str, amount: int, kind: str, series: Sequence[str] = ()
) -> DataFrame:
    """WN11: ``past`` moved by the distance, interpolated onto ``now``, then compared.

    Points before the first and after the last known result are trimmed.
    """
    moved = past.withColumn(time, shift(time, unit, amount))
    both = cut_lineage(align_series(now, moved, time, value, series))
    x, y = F.col(value).cast("double"), F.col(f"{value}__other")
    kinds = {
        "values": y,
        "absolute": x - y,
        "percentage": F.try_divide(x - y, y),
        "ratio": F.try_divide(x, y),
    }
    if kind not in kinds:
        raise QueryError(f"unknown comparison: {kind}")
    result = both.withColumn("change", kinds[kind]).select(*series, time, "change")
    known = result.where(F.col("change").isNotNull()).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    return result.where(
        (F.col(time) >= known.select("__lo").scalar()) & (F.col(time) <= known.select("__hi").scalar())
    )


def period_overlay(df: DataFrame, time: str, value: str, unit: str) -> DataFrame:
    """WN8: periods laid over the latest one: series ``current``, ``-1``, ``-2`` …"""
    df = cut_lineage(df)
    anchored = df.withColumn("__anchor", truncate(unit, time))
    # one row per period: the ranking never sees the points
    periods = anchored.select("__anchor").distinct()
    ranked = periods.withColumn("rank", (F.dense_rank().over(W.orderBy(F.desc("__anchor"))) - 1).cast("bigint"))
    newest = df.agg(truncate(unit, F.max(time)).alias("m")).scalar()
    most = ranked.agg(F.max("rank")).scalar()
    joined = join_null_safe(anchored, ranked, ["__anchor"], "inner")
    seconds = F.timestamp_diff("MICROSECOND", F.col("__anchor"), newest)
    overlaid = joined.select(
        F.timestamp_add("MICROSECOND", seconds, ntz(time)).alias(time),
        F.when(F.col("rank") == 0, F.lit("current")).otherwise(F.concat(F.lit("-"), F.col("rank").cast("string"))).alias("series"),
        "rank",
        F.col(value).cast("double").alias(value),
    )
    return overlaid.groupBy(time, "series", "rank").agg(F.avg(value).alias(value)).withColumn(
        "perc", 1 - F.try_divide(F.col("rank").cast("double"), (most + 1).cast("double"))
    )


def trend_headline(df: DataFrame, time: str, value: str, lag: int, series: Sequence[str] = ()) -> DataFrame:
    """WN9: newest known value, its time, and the change against the row ``lag`` places before the newest."""
    df = cut_lineage(df)
    newest_first = W.partitionBy(*(series or [F.lit(0)])).orderBy(F.desc(time))
    # rank limit keeps lag + 1 rows per series and task before the shuffle
    recent = df.withColumn("__n", F.row_number().over(newest_first)).where(F.col("__n") <= lag + 1)
    back = recent.groupBy(*series).agg(
        F.max(F.when(F.col("__n") == 1, F.col(value))).alias("__top"),
        F.max(F.when(F.col("__n") == lag + 1, F.col(value))).alias("__back"),
    )
    known = F.when(F.col(value).isNotNull(), F.col(time))
    head = df.groupBy(*series).agg(
        F.max_by(F.col(value), known).alias("headline"), F.max(known).alias("headline_time")
    )
    joined = join_null_safe(head, back, series, "left") if series else head.withColumns(
        {c: back.select(c).scalar() for c in ("__top", "__back")}
    )
    change = F.when(F.col("__back") == 0, F.lit(0.0)).otherwise(
        F.try_divide((F.col("headline") - F.col("__back")).cast("double"), F.abs("__back").cast("double"))
    )
    return joined.withColumn("change", F.when(F.lit(lag > 0), change)).drop("__top", "__back")


def fill_neighbor(df: DataFrame, series: Sequence[str], time: str, col: str, value: float, dense: bool = True) -> DataFrame:
    """WN10: a null next to a known value becomes ``value``."""
    placed = _positioned(df, series, time, dense)

    def outputs(order) -> dict[str, Column]:
        beside = F.lag(col).over(order).isNotNull() | F.lead(col).over(order).isNotNull()
        return {col: F.when(F.col(col).isNull() & beside, F.lit(value)).otherwise(F.col(col))}

    return _near(placed, series, 1, 1, outputs).drop(POS)


def series_frame(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    rolling_kind: str | None = None,
    window: int = 0,
    min_periods: int = 0,
    cumulate: str | None = None,
    resample_grain: str | None = None,
    resample_method: str = "asfreq",
    fill: float | None = None,
    contribution: str | None = None,
) -> DataFrame:
    """WN12: the fixed chain of a time chart on the long form, sorted by time."""
    result = densify(df, series, time)
    if rolling_kind:
        result = rolling(result, series, time, {value: value}, rolling_kind, window, min_periods)
    elif cumulate:
        result = cumulative(result, series, time, {value: value}, cumulate)
    if resample_grain:
        result = resample(result, series, time, [value], resample_grain, resample_method, fill)
    if contribution:
        known = F.coalesce(F.col(value), F.lit(0)).cast("double")
        over = list(series) if contribution == "column" else [time]
        totals = result.groupBy(*over).agg(F.sum(known).alias("__total"))
        result = join_null_safe(result, totals, over, "left")
        result = result.withColumn(value, F.try_divide(known, F.col("__total"))).drop("__total")
    return result.orderBy(time, *series)


FORECAST_GRAINS = (*CALENDAR_GRAINS, "PT5M", "PT10M", "PT15M", "PT30M", *WEEK_GRAINS)


def forecast(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    value: str,
    periods: int,
    grain: str,
    interval: float = 0.8,
    season: int = 0,
) -> DataFrame:
    """WN13: history plus ``periods`` future buckets with ``__yhat``, ``__yhat_lower``, ``__yhat_upper``.

    A straight line per series plus the mean residual of each place in the season, all closed
    form; the band is the normal quantile of the residual spread.
    """
    if grain not in FORECAST_GRAINS:
        raise QueryError(f"time grain {grain} cannot be forecast")
    if periods < 0:
        raise QueryError("periods must not be negative")
    if not 0 < interval < 1:
        raise QueryError("the interval lies between 0 and 1, exclusive")
    unit, amount = grain_step(grain)
    keys = list(series)
    x = F.col(POS).cast("double")
    past = cut_lineage(_positioned(df, keys, time, True)).withColumn("__y", F.col(value).cast("double"))
    season_of = F.pmod(F.col(POS), F.lit(season)) if season else F.lit(0)
    line = past.groupBy(*keys).agg(
        F.regr_slope("__y", x).alias("__b"),
        F.regr_intercept("__y", x).alias("__a"),
        F.max(POS).alias("__end"),
        F.max(time).alias("__last"),
    )
    fit = join_null_safe(past, line, keys, "inner")
    fit = fit.withColumns({"__line": F.col("__a") + F.col("__b") * x, "__place": season_of})
    by_place = fit.groupBy(*keys, "__place").agg(F.avg(F.col("__y") - F.col("__line")).alias("__s"))
    fit = join_null_safe(fit, by_place, [*keys, "__place"], "left")
    fit = fit.withColumn("__yhat", F.col("__line") + F.coalesce("__s", F.lit(0.0)))
    spread = fit.groupBy(*keys).agg(
        F.coalesce(F.stddev_samp(F.col("__y") - F.col("__yhat")), F.lit(0.0)).alias("__sd")
    )
    ahead = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("__h")) if periods else line.limit(0).withColumn("__h", F.lit(1))
    ahead = ahead.withColumn(POS, (F.col("__end") + F.col("__h")).cast("int"))
    ahead = ahead.withColumns(
        {
            time: shift("__last", unit, F.col("__h") * F.lit(amount)),
            "__line": F.col("__a") + F.col("__b") * x,
            "__place": season_of,
        }
    )
    ahead = join_null_safe(ahead, by_place, [*keys, "__place"], "left")
    ahead = ahead.withColumns({"__yhat": F.col("__line") + F.coalesce("__s", F.lit(0.0)), value: F.lit(None).cast(dict(df.dtypes)[value])})
    out = [*keys, time, value, "__yhat"]
    both = join_null_safe(fit.select(*out).unionByName(ahead.select(*out)), spread, keys, "left")
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    return both.select(
        *out,
        (F.col("__yhat") - F.lit(z) * F.col("__sd")).alias("__yhat_lower"),
        (F.col("__yhat") + F.lit(z) * F.col("__sd")).alias("__yhat_upper"),
    )


def event_paths(
    df: DataFrame, entity: str, event: str, order: Sequence[str], max_len: int, min_count: int = 1
) -> DataFrame:
    """WN14: how many entities start with each event sequence of up to ``max_len`` steps.

    The rank limit keeps ``max_len`` rows per entity and map task, so a hot entity never
    travels whole; sequences are at most ``max_len`` long.
    """
    place = F.row_number().over(W.partitionBy(entity).orderBy(*order))
    first = df.withColumn("__n", place).where(F.col("__n") <= max_len)
    steps = first.groupBy(entity).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("__n", event))), lambda s: s[event]).alias("steps")
    )
    prefix = steps.select(F.explode(F.sequence(F.lit(1), F.size("steps"))).alias("depth"), "steps")
    paths = prefix.select("depth", F.array_join(F.slice("steps", 1, F.col("depth")), " > ").alias("path"))
    counted = paths.groupBy("depth", "path").agg(F.count(F.lit(1)).alias("entities"))
    return counted.where(F.col("entities") >= min_count)
