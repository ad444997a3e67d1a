"""Datasets and declarative queries: one spec becomes one lazy DataFrame.

Order of work: filters, time bucket, grouping, series limit, having, order, page,
period comparison, post-processing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.grains import normalize_time, shift, time_bucket
from millrace.functions.timetext import TimeText, offset_of, span
from millrace.operators.filters import Filter, RowRule, apply_filters, between_times, free_clause, row_predicate
from millrace.operators.ordering import limit_with_flag
from millrace.operators.scale import join_null_safe

TIME_LABEL = "__timestamp"
OFFSET_SEPARATOR = "__"

# AG1: the simple aggregates.
SIMPLE_AGGREGATES: dict[str, Callable[[str], Column]] = {
    "COUNT": F.count,
    "COUNT_DISTINCT": F.countDistinct,
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
}


@dataclass(frozen=True)
class Metric:
    """A labelled aggregate: simple (column and aggregate) or free SQL (AG1, AG2)."""

    label: str
    column: str | None = None
    aggregate: str | None = None
    sql: str | None = None

    def expression(self) -> Column:
        if self.sql is not None:
            return F.expr(self.sql).alias(self.label)
        if self.aggregate not in SIMPLE_AGGREGATES:
            raise QueryError(f"unknown aggregate: {self.aggregate}")
        if self.aggregate == "COUNT" and self.column in (None, "*"):
            return F.count(F.lit(1)).alias(self.label)
        return SIMPLE_AGGREGATES[self.aggregate](self.column).alias(self.label)


@dataclass(frozen=True)
class Dimension:
    """A labelled grouping column, optionally SQL, optionally bucketed by a grain."""

    label: str
    sql: str | None = None
    grain: str | None = None

    def expression(self) -> Column:
        source = F.expr(self.sql) if self.sql else F.col(self.label)
        return time_bucket(source, self.grain).alias(self.label)


@dataclass(frozen=True)
class Dataset:
    """A frame with calculated columns, saved metrics, a main time column and row rules."""

    df: DataFrame
    time_col: str | None = None
    calculated: Mapping[str, str] = field(default_factory=dict)
    metrics: Mapping[str, str] = field(default_factory=dict)
    time_formats: Mapping[str, str] = field(default_factory=dict)
    offset_hours: int = 0
    fetch_predicate: str | None = None
    rules: Sequence[RowRule] = ()

    def frame(self, role: str | None = None) -> DataFrame:
        df = self.df
        bound = row_predicate(self.rules, role) if role is not None else None
        if bound is not None:
            df = df.where(bound)
        for column, fmt in self.time_formats.items():
            df = normalize_time(df, column, fmt)
        return df.withColumns({k: F.expr(v) for k, v in self.calculated.items()}) if self.calculated else df


@dataclass(frozen=True)
class QuerySpec:
    """What to compute; see the field names. ``metrics=None`` asks for raw rows."""

    dataset: Dataset
    columns: Sequence[str | Dimension] = ()
    metrics: Sequence[str | Metric] | None = None
    filters: Sequence[Filter] = ()
    where: str | None = None
    having: str | None = None
    grain: str | None = None
    is_timeseries: bool = False
    time_col: str | None = None
    since: datetime | None = None
    until: datetime | None = None
    time_range: str | None = None
    clock: TimeText | None = None
    orderby: Sequence[tuple[str | Metric, bool]] = ()
    series_columns: Sequence[str] = ()
    series_limit: int = 0
    series_limit_metric: str | Metric | None = None
    order_desc: bool = True
    inner_since: datetime | None = None
    inner_until: datetime | None = None
    row_limit: int | None = None
    row_offset: int = 0
    time_offsets: Sequence[str] = ()
    post_processing: Sequence[tuple[str, Mapping[str, object]]] = ()
    role: str | None = None
    null_safe_series: bool = True


def _dimension(item: str | Dimension) -> Dimension:
    return Dimension(item) if isinstance(item, str) else item


def _metric(item: str | Metric, dataset: Dataset) -> Metric:
    if isinstance(item, Metric):
        return item
    if item in dataset.metrics:
        return Metric(item, sql=dataset.metrics[item])
    raise QueryError(f"no such metric: {item}")


def _range(spec: QuerySpec) -> tuple[datetime | None, datetime | None]:
    if spec.time_range is not None:
        if spec.clock is None:
            raise QueryError("a time range in words needs a clock")
        return spec.clock.time_range(spec.time_range)
    return spec.since, spec.until


def scan(spec: QuerySpec, since: datetime | None, until: datetime | None) -> DataFrame:
    """Rows of the dataset inside the range that pass the filters."""
    df = spec.dataset.frame(spec.role)
    time_col = spec.time_col or spec.dataset.time_col
    if time_col and (since is not None or until is not None):
        df = df.where(between_times(F.col(time_col), since, until))
    df = apply_filters(df, spec.filters, spec.clock)
    return free_clause(df, spec.where)


def _dimensions(spec: QuerySpec) -> list[Dimension]:
    dims = {d.label: d for d in map(_dimension, spec.columns) if d.label != TIME_LABEL}
    if not spec.is_timeseries:
        return list(dims.values())
    time_col = spec.time_col or spec.dataset.time_col
    if not time_col:
        raise QueryError("a time column is required")
    return [Dimension(TIME_LABEL, sql=time_col, grain=spec.grain), *dims.values()]


def top_series(
    df: DataFrame,
    series: Sequence[str],
    metric: Column,
    n: int,
    desc: bool = True,
    ranked_on: DataFrame | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """J3: rows whose series is among the top ``n``; ties go to the smaller label.

    ``ranked_on`` ranks over other rows (the outer range).
    """
    ranked = (ranked_on if ranked_on is not None else df).groupBy(*series).agg(metric.alias("__rank"))
    key = F.col("__rank").desc_nulls_last() if desc else F.col("__rank").asc_nulls_last()
    top = ranked.orderBy(key, *series).limit(n).select(*series)
    return in_groups(df, top, series, null_safe)


def in_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """J4: rows whose key combination is listed in ``groups`` (any number of groups)."""
    if null_safe:
        return join_null_safe(df, groups, keys, "left_semi")
    return df.join(groups, list(keys), "left_semi")


def group_query(spec: QuerySpec, since: datetime | None, until: datetime | None) -> DataFrame:
    """AG3: raw rows, distinct groups or grouped metrics, with series limit, having and order."""
    dims = _dimensions(spec)
    ordered = [(_metric(o, spec.dataset) if isinstance(o, Metric) or o in spec.dataset.metrics else o, up) for o, up in spec.orderby]
    metrics = [_metric(m, spec.dataset) for m in spec.metrics or ()]
    labels = {m.label for m in metrics}
    hidden = [o for o, _ in ordered if isinstance(o, Metric) and o.label not in labels]
    grouped = spec.metrics is not None or bool(hidden)
    if not dims and not metrics:
        raise QueryError("empty query")
    df = scan(spec, since, until)
    if not grouped:
        result = df.select(*[d.expression() for d in dims])
        names = [d.label for d in dims]
    else:
        df = df.withColumns({d.label: d.expression() for d in dims}) if dims else df
        names = [d.label for d in dims]
        if spec.series_limit and spec.series_columns:
            rank = spec.series_limit_metric or (metrics[0] if metrics else Metric("n", aggregate="COUNT"))
            inner = None
            if spec.inner_since or spec.inner_until:
                inner = scan(spec, spec.inner_since, spec.inner_until)
                inner = inner.withColumns({d.label: d.expression() for d in dims if d.label != TIME_LABEL})
            df = top_series(
                df,
                spec.series_columns,
                _metric(rank, spec.dataset).expression(),
                spec.series_limit,
                spec.order_desc,
                inner,
                spec.null_safe_series,
            )
        every = [*metrics, *hidden]
        if every:
            result = df.groupBy(*names).agg(*[m.expression() for m in every])
        else:
            result = df.select(*names).distinct()
        result = free_clause(result, spec.having)
    keys = []
    for target, up in ordered:
        key = F.col(target.label if isinstance(target, Metric) else target)
        keys.append(key.asc_nulls_last() if up else key.desc_nulls_last())
    if spec.row_offset and not keys:
        raise QueryError("an offset needs an order")
    if keys:
        result = result.orderBy(*keys)
    if spec.row_offset:
        result = result.offset(spec.row_offset)
    if spec.row_limit:
        result = result.limit(spec.row_limit)
    result = result.select(*names, *[m.label for m in metrics])
    if spec.dataset.offset_hours and TIME_LABEL in names:
        result = result.withColumn(TIME_LABEL, shift(TIME_LABEL, "hour", spec.dataset.offset_hours))
    return result


def time_offset_join(spec: QuerySpec, offsets: Sequence[str]) -> DataFrame:
    """J5: the same query over shifted ranges, moved back in time and left-joined.

    Each metric gains ``metric__<offset>`` columns. Sides are grouped first, so the join is one
    row to one row.
    """
    since, until = _range(spec)
    if since is None or until is None:
        raise QueryError("a time comparison needs both ends of the range")
    result = group_query(spec, since, until)
    metrics = [_metric(m, spec.dataset).label for m in spec.metrics or ()]
    keys = [c for c in result.columns if c not in metrics]
    axis = TIME_LABEL if TIME_LABEL in keys else next(
        (d.label for d in map(_dimension, spec.columns) if d.grain), None
    )
    if axis is None:
        raise QueryError("a time comparison needs a time column")
    for offset in offsets:
        unit, amount = offset_of(offset)
        moved = replace(
            spec,
            inner_since=since,
            inner_until=until,
            orderby=(),
            row_limit=None,
            row_offset=0,
            filters=[f for f in spec.filters if f.col != axis],
        )
        other = group_query(moved, since + span(unit, amount), until + span(unit, amount))
        other = other.withColumns(
            {"__from": F.col(axis), axis: shift(axis, "month" if unit == "quarter" else unit, -amount * (3 if unit == "quarter" else 1))}
        )
        names = {m: f"{m}{OFFSET_SEPARATOR}{offset}" for m in metrics}
        if unit in ("month", "quarter", "year") and spec.grain not in ("P1M", "P3M", "P1Y"):
            # month ends may fold onto one date: the day of the same number wins, one row per key
            other = other.groupBy(*keys).agg(*[F.min_by(m, "__from").alias(n) for m, n in names.items()])
        else:
            other = other.drop("__from").withColumnsRenamed(names)
        result = join_null_safe(result, other, keys, "left")
    return result


def run_query(spec: QuerySpec) -> DataFrame:
    """The whole lifecycle of one spec."""
    if spec.time_offsets:
        result = time_offset_join(spec, spec.time_offsets)
    else:
        result = group_query(spec, *_range(spec))
    from millrace.operators.steps import apply_step

    for name, options in spec.post_processing:
        result = apply_step(result, name, options)
    return result


def run_sql(
    spark: SparkSession, text: str, args: Mapping[str, object] | None = None, limit: int | None = None
) -> tuple[DataFrame, bool]:
    """Free SQL over published tables with named parameters; at most ``limit`` rows and whether more exist."""
    result = spark.sql(text, args=dict(args or {}))
    return (result, False) if limit is None else limit_with_flag(result, limit)


def publish(dataset: Dataset, name: str, role: str | None = None) -> None:
    """A dataset, its rules applied, under a name SQL can use as a table."""
    dataset.frame(role).createOrReplaceTempView(name)


def row_count(spec: QuerySpec) -> DataFrame:
    """AG4: rows of the whole query, its limit included."""
    return run_query(spec).agg(F.count(F.lit(1)).alias("rowcount"))


def grand_total(spec: QuerySpec) -> DataFrame:
    """AG5: the metrics over everything the filters keep."""
    return run_query(
        replace(spec, columns=(), is_timeseries=False, orderby=(), row_limit=None, row_offset=0, post_processing=(), series_limit=0)
    )


