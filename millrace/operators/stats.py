"""Distributions and tests (AG7, AG19-AG21, AG38, J12)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.operators.scale import join_null_safe, quantile_columns, ranked_counts
from millrace.session import cut_lineage


def _whiskers(whisker: str, percentiles: Sequence[float] | None) -> dict[str, tuple[float, str]]:
    if whisker == "percentile":
        valid = isinstance(percentiles, (list, tuple)) and len(percentiles) == 2 and all(
            isinstance(p, (int, float)) for p in percentiles
        )
        if not valid or percentiles[0] >= percentiles[1]:
            raise QueryError("percentiles are two numbers, the first below the second")
        return {"__lo": (percentiles[0] / 100, "linear"), "__hi": (percentiles[1] / 100, "linear")}
    if whisker not in ("tukey", "min/max"):
        raise QueryError(f"unknown whisker type: {whisker}")
    return {}


def _box(df: DataFrame, groupby: Sequence[str], metric: str, whisker: str, percentiles) -> tuple[DataFrame, DataFrame]:
    """Folded values of one metric with their group's limits, and the per-group quartiles."""
    wanted = {
        "__q1": (0.25, "midpoint"),
        "__q3": (0.75, "midpoint"),
        "__median": (0.5, "linear"),
        **_whiskers(whisker, percentiles),
    }
    ranked = ranked_counts(df.withColumn(metric, F.col(metric).try_cast("double")), groupby, metric)
    limits = ranked.groupBy(*groupby).agg(
        *quantile_columns(metric, wanted),
        (F.try_divide(F.sum(F.col(metric) * F.col("n")), F.sum("n").cast("double"))).alias("__mean"),
        F.sum("n").alias("__count"),
        F.min(metric).alias("__least"),
        F.max(metric).alias("__most"),
    )
    if whisker == "tukey":
        spread = 1.5 * (F.col("__q3") - F.col("__q1"))
        limits = limits.withColumns({"__lo": F.col("__q1") - spread, "__hi": F.col("__q3") + spread})
    elif whisker == "min/max":
        limits = limits.withColumns({"__lo": F.col("__least"), "__hi": F.col("__most")})
    folded = df.select(*groupby, F.col(metric).try_cast("double").alias(metric)).where(F.col(metric).isNotNull())
    folded = folded.groupBy(*groupby, metric).agg(F.count(F.lit(1)).alias("n"))
    return join_null_safe(folded, limits.select(*groupby, "__lo", "__hi"), groupby, "inner"), limits


def boxplot(
    df: DataFrame, groupby: Sequence[str], metrics: Sequence[str], whisker: str = "tukey", percentiles: Sequence[float] | None = None
) -> DataFrame:
    """AG7: per metric ``__mean __median __max __min __q1 __q3 __count __outliers``.

    Quartiles are the midpoint of the neighbouring values. Tukey whiskers are the extreme values
    within 1.5 quartile ranges. ``__outliers`` counts the values beyond; ``boxplot_outliers``
    lists them as rows, because a hot group's list has no size bound.
    """
    groupby = list(groupby)
    parts = []
    for m in metrics:
        values, limits = _box(df, groupby, m, whisker, percentiles)
        x = F.col(m)
        inside = values.groupBy(*groupby).agg(
            F.max(F.when(x <= F.col("__hi"), x)).alias("__top"),
            F.min(F.when(x >= F.col("__lo"), x)).alias("__bottom"),
            F.sum(F.when((x > F.col("__hi")) | (x < F.col("__lo")), F.col("n")).otherwise(0)).alias("__out"),
        )
        both = join_null_safe(limits, inside, groupby, "left")
        high, low = ("__hi", "__lo") if whisker == "percentile" else ("__top", "__bottom")
        parts.append(
            both.select(
                *groupby,
                F.col("__mean").alias(f"{m}__mean"),
                F.col("__median").alias(f"{m}__median"),
                F.col(high).alias(f"{m}__max"),
                F.col(low).alias(f"{m}__min"),
                F.col("__q1").alias(f"{m}__q1"),
                F.col("__q3").alias(f"{m}__q3"),
                F.col("__count").alias(f"{m}__count"),
                F.col("__out").alias(f"{m}__outliers"),
            )
        )
    return reduce(lambda a, b: join_null_safe(a, b, groupby, "left"), parts)


def boxplot_outliers(
    df: DataFrame, groupby: Sequence[str], metric: str, whisker: str = "tukey", percentiles: Sequence[float] | None = None
) -> DataFrame:
    """AG7: every value beyond the whiskers with its side and how often it occurs."""
    values, _ = _box(df, list(groupby), metric, whisker, percentiles)
    x = F.col(metric)
    beyond = values.where((x > F.col("__hi")) | (x < F.col("__lo")))
    side = F.when(x > F.col("__hi"), F.lit("above")).otherwise(F.lit("below"))
    return beyond.select(*groupby, x.alias("value"), side.alias("side"), "n")


def histogram(
    df: DataFrame, col: str, bins: int = 15, groupby: Sequence[str] = (), normalized: bool = False, cumulative: bool = False
) -> DataFrame:
    """AG19: equal-width bins over the whole range, the last one closed; groups share the bins."""
    groupby = list(groupby)
    known = df.where(F.col(col).isNotNull())
    x = F.col(col).cast("double")
    ends = known.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.floor(F.try_divide((x - lo) * bins, hi - lo))
    number = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = known.groupBy(*groupby, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # one slot per bin: at most ``bins`` numbers per group
    slots = counts.groupBy(*groupby).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"), F.sum("n").alias("total")
    )
    numbers = F.sequence(F.lit(0), F.lit(bins - 1))
    filled = F.transform(numbers, lambda b: F.coalesce(F.try_element_at("m", b), F.lit(0).cast("bigint")))
    if cumulative:
        filled = F.transform(numbers, lambda b: F.aggregate(F.slice(filled, 1, b + 1), F.lit(0).cast("bigint"), lambda s, v: s + v))
    rows = slots.select(*groupby, "total", F.posexplode(filled).alias("bin", "count"))
    width = (hi - lo) / bins
    value = F.try_divide(F.col("count").cast("double"), F.col("total").cast("double")) if normalized else F.col("count")
    return rows.select(
        *groupby,
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        value.alias("count"),
    )


def break_points(df: DataFrame, col: str, n: int = 10, breaks: Sequence[float] | None = None) -> list[float]:
    """AG20: bucket edges over the extent (two numbers on the driver), or the given ones sorted."""
    if breaks:
        return sorted(float(b) for b in breaks)
    ends = df.agg(F.min(col).cast("double").alias("low"), F.max(col).cast("double").alias("high")).where("low IS NOT NULL")
    decimals = F.when(F.col("high") > F.col("low"), F.greatest(F.ceil(-F.log10("step")), F.lit(0))).otherwise(F.lit(0))
    scale = F.pow(F.lit(10.0), decimals)
    # the first edge is rounded down so that it never passes the least value; one more edge if the last falls short
    first = F.floor(F.col("low") * F.col("scale")) / F.col("scale")
    edge = lambda i: F.round((first + i * F.col("step")) * F.col("scale")) / F.col("scale")
    last = F.when(edge(F.lit(n)) < F.col("high"), n + 1).otherwise(n)
    rows = ends.withColumn("step", (F.col("high") - F.col("low")) / n).withColumn("scale", scale)
    found = rows.select(F.transform(F.sequence(F.lit(0), last), edge)).first()
    return found[0] if found else []


def bucketize(df: DataFrame, col: str, edges: Sequence[float], target: str = "bucket") -> DataFrame:
    """AG20: number of edges at or below the value."""
    steps = [F.when(F.col(col) >= F.lit(float(e)), 1).otherwise(0) for e in edges]
    count = reduce(lambda a, b: a + b, steps, F.lit(0))
    return df.withColumn(target, F.when(F.col(col).isNotNull(), count))


def normalize_cells(df: DataFrame, x: str, y: str, v: str, across: str = "heatmap") -> DataFrame:
    """AG21: ``perc`` (min-max) and ``rank`` (average-rank percent) per x, per y, or overall."""
    if across not in ("heatmap", x, y):
        raise QueryError(f"cannot normalise across {across}")
    df = cut_lineage(df.select(x, y, v))
    over = [] if across == "heatmap" else [across]
    if over and len(df.select(across).distinct().take(2)) <= 1:
        over = []
    ranked = ranked_counts(df, over, v).withColumn(
        "rank", (F.col("below") + (F.col("n") + 1) / 2) / F.col("total")
    )
    ends = df.groupBy(*over).agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    cells = join_null_safe(df, ends, over, "left")
    cells = join_null_safe(cells, ranked.select(*over, v, "rank"), [*over, v], "left")
    perc = F.try_divide((F.col(v) - F.col("__lo")).cast("double"), (F.col("__hi") - F.col("__lo")).cast("double"))
    return cells.select(x, y, v, perc.alias("perc"), "rank")


def pair_with_control(df: DataFrame, time: str, group: str, value: str, control: object) -> DataFrame:
    """J12: each group's value beside the control group's value at the same time."""
    base = df.where(F.col(group) == F.lit(control)).select(time, F.col(value).alias("control_value"))
    return join_null_safe(df.where(F.col(group) != F.lit(control)), base, [time], "inner")


#: Steps of the continued fraction below: enough for full precision at any number of degrees of freedom.
_FRACTION_STEPS = 300


def _gamma_step(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)): by its series at a + 20, walked back in 20 steps."""
    z = a + 20
    series = 0.5 * F.log(z) - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7)
    back = F.aggregate(F.sequence(F.lit(0), F.lit(19)), F.lit(0.0), lambda total, k: total + F.log((a + k) / (a + k + 0.5)))
    return series + back


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, from the front, in a fixed number of steps."""
    some = lambda v: F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)
    first = 1 / some(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def link(state: Column, part: Column) -> Column:
        d, c = 1 / some(1 + part * state["d"]), some(1 + part / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    def step(state: Column, k: Column) -> Column:
        # even places 2m and odd places 2m + 1 by turns
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return link(state, F.when(k % 2 == 0, even).otherwise(odd))

    return F.aggregate(F.sequence(F.lit(2), F.lit(_FRACTION_STEPS)), start, step)["h"]


def student_two_sided(t: Column, freedom: Column) -> Column:
    """P(|T| >= |t|) for Student's distribution; null below one degree of freedom.

    It is the incomplete beta function of freedom / 2 and 1/2 at freedom / (freedom + t^2). Far tails are computed as
    they are, not as what is left to 1, so that they keep their precision.
    """
    v, square = freedom.cast("double"), t * t
    a, half = v / 2, F.lit(0.5)
    far, near = v / (v + square), square / (v + square)
    front = F.exp(_gamma_step(a) - a * F.log1p(square / v)) * F.sqrt(near) / math.sqrt(math.pi)
    tail = front / a * _beta_fraction(a, half, far)
    middle = 1 - front / half * _beta_fraction(half, a, near)
    value = F.when(far < (a + 1) / (a + 2.5), tail).otherwise(middle)
    value = F.when(F.abs(t) == float("inf"), F.lit(0.0)).otherwise(value)
    return F.when(t.isNotNull() & (freedom >= 1), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def paired_ttest(df: DataFrame, time: str, group: str, value: str, control: object, p_value: bool = True) -> DataFrame:
    """AG38: paired Student test and lift of each group against the control group.

    Pairs whose difference is null or not finite do not count.
    """
    pairs = pair_with_control(df, time, group, value, control)
    d = F.col("control_value").cast("double") - F.col(value).cast("double")
    pairs = pairs.where(~F.isnan(d) & (F.abs(d) < float("inf")))
    sums = pairs.groupBy(group).agg(
        F.count(d).alias("n"),
        F.sum(d).alias("__d"),
        F.sum(d * d).alias("__dd"),
        F.sum(value).cast("double").alias("__v"),
        F.sum("control_value").cast("double").alias("__c"),
    )
    n = F.col("n").cast("double")
    inner = F.try_divide(n - 1, n * F.col("__dd") - F.col("__d") * F.col("__d"))
    t = -F.abs(F.col("__d") * F.sqrt(F.when(inner >= 0, inner)))
    lift = F.try_divide(F.col("__v") - F.col("__c"), F.col("__c")) * 100
    result = sums.select(group, "n", t.alias("t"), lift.alias("lift"))
    return result.withColumn("p", student_two_sided(F.col("t"), F.col("n") - 1)) if p_value else result


