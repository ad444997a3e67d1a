"""Pivots (AG8-AG11, AG23, AG24). Everything is aggregated long first; wide comes last.

The ``..._long`` forms return (index, label, metrics) rows, totals included, for any number of labels, and nothing of them
passes through the driver. The wide forms take the labels that become columns from the caller, or, as far as Spark's
bound on pivots goes, from the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.text import LABEL_SEPARATOR, NULL_LABEL, escape_label, natural_key
from millrace.operators.aggregates import aggregate, contribution, null_label
from millrace.operators.scale import bounded_labels, join_null_safe
from millrace.session import cut_lineage

LABEL = "__label"


def flat_label(columns: Sequence[str]) -> Column:
    """AG9: one label from several columns; commas inside a value are escaped, nulls skipped."""
    parts = [F.replace(F.col(c).cast("string"), F.lit(","), F.lit("\\,")) for c in columns]
    return F.concat_ws(LABEL_SEPARATOR, *parts)


def flatten(df: DataFrame, metric: str, series: Sequence[str], drop_metric: bool = False) -> DataFrame:
    """AG9 on the long form: the flat column name each cell would have when pivoted."""
    tail = flat_label(series)
    name = tail if drop_metric else F.concat_ws(LABEL_SEPARATOR, F.lit(escape_label(metric)), tail)
    return df.withColumn("column_name", name)


def _known_labels(long: DataFrame, metrics: Sequence[str]) -> list:
    """Labels with, per metric, how many cells hold a value: one small bounded result."""
    rows = bounded_labels(long.groupBy(LABEL).agg(*[F.count(m).alias(f"n{i}") for i, m in enumerate(metrics)]))
    return sorted(rows, key=lambda r: r[LABEL])


def widen(
    long: DataFrame,
    index: Sequence[str],
    metrics: Sequence[str],
    fill: object = None,
    drop_missing: bool = True,
    combine: bool = False,
    given: Sequence[str] | None = None,
) -> DataFrame:
    """(index, label, metrics) rows to one column per label and metric.

    With ``given`` labels these become the columns, in their order, and nothing is collected. Otherwise the folded
    cells are settled once: the label list and the table both read them.
    """
    if given is None:
        long = cut_lineage(long)
        labels = _known_labels(long, metrics)
    else:
        labels = [{LABEL: label} | {f"n{i}": 1 for i in range(len(metrics))} for label in dict.fromkeys(given)]
    values = [r[LABEL] for r in labels]
    # index columns go by place while wide: a label may spell the same as an index name
    placed = long.select(*[F.col(c).alias(f"__i{i}") for i, c in enumerate(index)], LABEL, *metrics)
    wide = placed.groupBy(*[f"__i{i}" for i in range(len(index))]).pivot(LABEL, values).agg(
        *[F.max(m).alias(m) for m in metrics]
    )
    out = []
    for i, metric in enumerate(metrics):
        for row in labels:
            if drop_missing and row[f"n{i}"] == 0:
                continue
            source = row[LABEL] if len(metrics) == 1 else f"{row[LABEL]}_{metric}"
            pair = (row[LABEL], escape_label(metric)) if combine else (escape_label(metric), row[LABEL])
            cell = F.col(f"`{source}`")
            cell = F.coalesce(cell, F.lit(fill)) if fill is not None else cell
            out.append((row[LABEL], i, cell.alias(LABEL_SEPARATOR.join(p for p in pair if p))))
    if combine:
        out.sort(key=lambda t: (t[0], t[1]))
    return wide.select(*[F.col(f"__i{i}").alias(c) for i, c in enumerate(index)], *[c for _, _, c in out])


# Operators whose totals can be taken from folded cells, and by what.
_REFOLD_OPERATORS = {
    "sum": "sum", "nansum": "sum", "count": "sum", "count_nonzero": "sum",
    "min": "min", "nanmin": "min", "max": "max", "nanmax": "max",
}


def _operator(spec: tuple | Mapping[str, object]) -> object:
    return spec.get("operator") if isinstance(spec, Mapping) else spec[1]


def _long_cells(
    df: DataFrame,
    index: Sequence[str],
    columns: Sequence[str],
    aggs: Mapping[str, tuple | Mapping[str, object]],
    column_fill: str | None,
    drop_missing: bool,
    margins: bool,
    margin_name: str,
) -> DataFrame:
    """(index, label, metrics) rows of a pivot, with its totals."""
    index, columns, metrics = list(index), list(columns or ()), list(aggs)
    if not index:
        raise QueryError("a pivot needs at least one index column")
    if not aggs:
        raise QueryError("a pivot needs at least one aggregate")
    if columns:
        if column_fill:
            df = null_label(df, columns)
        else:
            df = df.dropna(subset=columns)
    labelled = df.withColumn(LABEL, flat_label(columns) if columns else F.lit(""))
    long = aggregate(labelled, [*index, LABEL], aggs)
    if drop_missing:
        long = long.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in metrics]))
    if margins:
        totals = [F.lit(margin_name), *[F.lit("")] * (len(index) - 1)]
        long = long.withColumns({c: F.col(c).cast("string") for c in index})
        operators = {m: _operator(spec) for m, spec in aggs.items()}
        if all(op in _REFOLD_OPERATORS for op in operators.values()):
            # totals of the folded cells are the totals of the rows
            source, again = long, {m: (m, _REFOLD_OPERATORS[op]) for m, op in operators.items()}
        else:
            source, again = labelled, aggs
        by_row = aggregate(source, index, again).withColumn(LABEL, F.lit(margin_name))
        by_col = aggregate(source, [LABEL], again).select(*[t.alias(c) for t, c in zip(totals, index)], LABEL, *metrics)
        whole = aggregate(source, [], again).select(
            *[t.alias(c) for t, c in zip(totals, index)], F.lit(margin_name).alias(LABEL), *metrics
        )
        parts = [long, by_row.withColumns({c: F.col(c).cast("string") for c in index}), by_col, whole]
        long = reduce(lambda a, b: a.unionByName(b), parts if columns else [parts[0], by_col])
    return long


def pivot_long(
    df: DataFrame,
    index: Sequence[str],
    columns: Sequence[str],
    aggs: Mapping[str, tuple | Mapping[str, object]],
    column_fill: str | None = NULL_LABEL,
    drop_missing: bool = True,
    margins: bool = False,
    margin_name: str = "All",
    label: str = "label",
) -> DataFrame:
    """AG8 as rows: one per index and label, with totals; any number of labels."""
    return _long_cells(df, index, columns, aggs, column_fill, drop_missing, margins, margin_name).withColumnRenamed(LABEL, label)


def pivot(
    df: DataFrame,
    index: Sequence[str],
    columns: Sequence[str],
    aggs: Mapping[str, tuple | Mapping[str, object]],
    fill: object = None,
    column_fill: str | None = NULL_LABEL,
    drop_missing: bool = True,
    combine: bool = False,
    margins: bool = False,
    margin_name: str = "All",
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """AG8: a wide table of aggregates, column names ``metric, value1, value2``."""
    long = _long_cells(df, index, columns, aggs, column_fill, drop_missing, margins, margin_name)
    return widen(long, list(index), list(aggs), fill, drop_missing, combine, labels)


TOTAL = "Total ({})"
SUBTOTAL = "Subtotal"

# AG11: names and meanings of the pivot-table aggregators.
CELL_AGGREGATORS = (
    "Count",
    "Count Unique Values",
    "List Unique Values",
    "Sum",
    "Integer Sum",
    "Average",
    "Median",
    "Sample Variance",
    "Sample Standard Deviation",
    "Minimum",
    "Maximum",
    "First",
    "Last",
    "Sum over Sum",
    "Sum as Fraction of Total",
    "Sum as Fraction of Rows",
    "Sum as Fraction of Columns",
    "Count as Fraction of Total",
    "Count as Fraction of Rows",
    "Count as Fraction of Columns",
)


def _cell_value(name: str, value: str, other: str | None) -> Column:
    v = F.col(value)
    n = F.count(v)
    if name.startswith("Count Unique"):
        return F.countDistinct(v)
    if name.startswith("List Unique"):
        return F.array_join(F.array_sort(F.collect_set(v.cast("string"))), ", ")
    if name.startswith("Count"):
        return n
    if name == "Sum over Sum":
        return F.try_divide(F.sum(v).cast("double"), F.sum(other or value).cast("double"))
    if name == "Integer Sum":
        return F.sum(v.cast("bigint"))
    if name.startswith("Sum"):
        return F.coalesce(F.sum(v), F.lit(0))
    if name == "Average":
        return F.avg(v)
    if name == "Sample Variance":
        return F.when(n > 1, F.var_samp(v)).otherwise(F.lit(0.0))
    if name == "Sample Standard Deviation":
        return F.when(n > 1, F.stddev_samp(v)).otherwise(F.lit(0.0))
    if name == "Minimum":
        return F.min(v)
    if name == "Maximum":
        return F.max(v)
    raise QueryError(f"unknown pivot aggregator: {name}")


def cell_columns(df: DataFrame, name: str, values: Sequence[str], other: str | None = None) -> list[Column]:
    """The built-in aggregates behind one aggregator (all but Median)."""
    if name not in ("First", "Last"):
        return [_cell_value(name, v, other).alias(v) for v in values]
    pick = F.min_by if name == "First" else F.max_by
    kinds = dict(df.dtypes)

    def natural(v: str) -> Column:
        return natural_key(v) if kinds[v] == "string" else F.col(v)

    return [pick(F.col(v), F.struct(natural(v), F.col(v))).alias(v) for v in values]


def cell_aggregate(
    df: DataFrame, groups: Sequence[str], name: str, values: Sequence[str], other: str | None = None
) -> DataFrame:
    """One AG11 aggregator of several value columns per group (fractions still unscaled)."""
    if name not in CELL_AGGREGATORS:
        raise QueryError(f"unknown pivot aggregator: {name}")
    groups = list(groups)
    if name == "Median":
        return aggregate(df, groups, {v: (v, "median") for v in values})
    return df.groupBy(*groups).agg(*cell_columns(df, name, values, other))


def pivot_cells(
    df: DataFrame, rows: Sequence[str], cols: Sequence[str], name: str, value: str, other: str | None = None
) -> DataFrame:
    """AG11: one row per cell with its aggregate; fractions divide by totals of the folded cells."""
    groups = [*rows, *cols]
    cells = cell_aggregate(df, groups, name, [value], other)
    if " as Fraction of " not in name:
        return cells
    whole = {"Total": [], "Rows": list(rows), "Columns": list(cols)}[name.rsplit(" ", 1)[1]]
    totals = cells.groupBy(*whole).agg(F.sum(value).cast("double").alias("__t"))
    joined = join_null_safe(cells, totals, whole, "left")
    return joined.withColumn(value, F.try_divide(F.col(value).cast("double"), F.col("__t"))).drop("__t")


# Aggregators whose subtotals can be taken from already folded cells.
_REFOLD = {"Sum": F.sum, "Count": F.sum, "Minimum": F.min, "Maximum": F.max}


def pivot_levels(
    df: DataFrame, rows: Sequence[str], cols: Sequence[str], metrics: Sequence[str], agg: str = "Sum",
    row_prefixes: Sequence[int] | None = None, col_prefixes: Sequence[int] | None = None,
) -> DataFrame:
    """AG10, long form: every wanted prefix of the row and column hierarchies, with its depth.

    ``row_depth`` / ``col_depth`` say how many leading columns a row keeps.
    """
    rows, cols = list(rows), list(cols)
    row_prefixes = range(len(rows) + 1) if row_prefixes is None else row_prefixes
    col_prefixes = range(len(cols) + 1) if col_prefixes is None else col_prefixes
    groups = [*rows, *cols]
    if agg != "Median" and groups:
        sets = [[*rows[:i], *cols[:j]] for i in row_prefixes for j in col_prefixes]

        def depth(names: Sequence[str]) -> Column:
            return reduce(lambda a, b: a + b, [1 - F.grouping(c).cast("int") for c in names], F.lit(0))

        if agg in _REFOLD:
            df, values = cell_aggregate(df, groups, agg, metrics), [_REFOLD[agg](m).alias(m) for m in metrics]
        else:
            # one scan for all levels; partial aggregates travel, not rows
            values = cell_columns(df, agg, metrics)
        return df.groupingSets(sets, *groups).agg(depth(rows).alias("row_depth"), depth(cols).alias("col_depth"), *values)
    parts = []
    for i in row_prefixes:
        for j in col_prefixes:
            part = cell_aggregate(df, [*rows[:i], *cols[:j]], agg, metrics)
            missing = {c: F.lit(None).cast(dict(df.dtypes)[c]) for c in [*rows[i:], *cols[j:]]}
            part = part.withColumns(missing) if missing else part
            parts.append(part.select(*groups, F.lit(i).alias("row_depth"), F.lit(j).alias("col_depth"), *metrics))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _total_labels(names: Sequence[str], depth: str, total: str) -> list[Column]:
    """Labels of a (sub)total: kept values, then the total's name, then blanks."""
    out = []
    for i, name in enumerate(names):
        label = F.when(F.col(depth) > i, F.col(name).cast("string"))
        label = label.when(F.col(depth) == i, F.lit(total if i == 0 else SUBTOTAL)).otherwise(F.lit(""))
        out.append(label.alias(name))
    return out


def pivot_table(
    df: DataFrame,
    rows: Sequence[str],
    cols: Sequence[str],
    metrics: Sequence[str],
    agg: str = "Sum",
    transpose: bool = False,
    combine: bool = False,
    row_totals: bool = False,
    col_totals: bool = False,
    metrics_on_rows: bool = False,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """AG10: a pivot table with optional totals and nested subtotals on both axes.

    ``row_totals`` adds total columns, ``col_totals`` adds total rows. Totals come from the data.
    """
    rows, long = _table_cells(df, rows, cols, metrics, agg, transpose, row_totals, col_totals)
    if metrics_on_rows:
        melted = long.unpivot([*rows, LABEL], list(metrics), "metric_name", "value")
        return widen(melted, ["metric_name", *rows], ["value"], combine=combine, given=labels)
    return widen(long, rows, metrics, combine=combine, given=labels)


def pivot_table_long(
    df: DataFrame,
    rows: Sequence[str],
    cols: Sequence[str],
    metrics: Sequence[str],
    agg: str = "Sum",
    transpose: bool = False,
    row_totals: bool = False,
    col_totals: bool = False,
    label: str = "label",
) -> DataFrame:
    """AG10 as rows: one per row and label, totals and subtotals included; any number of labels."""
    return _table_cells(df, rows, cols, metrics, agg, transpose, row_totals, col_totals)[1].withColumnRenamed(LABEL, label)


def _table_cells(
    df: DataFrame, rows: Sequence[str], cols: Sequence[str], metrics: Sequence[str], agg: str, transpose: bool, row_totals: bool, col_totals: bool
) -> tuple[list[str], DataFrame]:
    """The row columns of a pivot table and its (rows, label, metrics) cells."""
    rows, cols = (list(cols), list(rows)) if transpose else (list(rows), list(cols))
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in [*rows, *cols]}) if rows or cols else df
    fraction = None
    base = agg
    if " as Fraction of " in agg:
        base, fraction = agg.split(" as Fraction of ")
    total = TOTAL.format(agg)
    long = pivot_levels(
        filled, rows, cols, metrics, base,
        None if col_totals and rows else [len(rows)],
        None if row_totals and cols else [len(cols)],
    )
    if fraction:
        keep = {"Total": [], "Rows": rows, "Columns": cols}[fraction]
        cells = long.where((F.col("row_depth") == len(rows)) & (F.col("col_depth") == len(cols)))
        sums = cells.groupBy(*keep).agg(*[F.sum(m).cast("double").alias(f"__t_{m}") for m in metrics])
        long = join_null_safe(long, sums, keep, "left")
        long = long.withColumns({m: F.try_divide(F.col(m).cast("double"), F.col(f"__t_{m}")) for m in metrics})
    long = long.select(*_total_labels(rows, "row_depth", total), *_total_labels(cols, "col_depth", total), *metrics)
    long = long.withColumn(LABEL, flat_label(cols) if cols else F.lit(""))
    if not rows:
        rows, long = ["metric"], long.withColumn("metric", F.lit(total))
    return rows, long.select(*rows, LABEL, *metrics)


def dist_bar(
    df: DataFrame, groupby: Sequence[str], columns: Sequence[str], metrics: Sequence[str], sort_by: str | None = None,
    descending: bool = True, share: bool = False, labels: Sequence[str] | None = None,
) -> DataFrame:
    """AG23: bars per group, ordered by the total of the sort metric; optional share within a bar."""
    groupby = list(groupby)
    named = null_label(df, [*groupby, *columns])
    order = named.groupBy(*groupby).agg(F.sum(sort_by or metrics[0]).alias("sort_total"))
    wide = pivot(named, groupby, columns, {m: (m, "mean") for m in metrics}, labels=labels)
    if share:
        cells = [c for c in wide.columns if c not in groupby]
        totals = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in cells])
        wide = wide.select(*groupby, *[F.try_divide(F.col(f"`{c}`").cast("double"), totals).alias(c) for c in cells])
    joined = join_null_safe(wide, order, groupby, "left")
    key = F.col("sort_total").desc_nulls_last() if descending else F.col("sort_total").asc_nulls_last()
    return joined.orderBy(key, *groupby)


def time_table(df: DataFrame, time: str, metrics: Sequence[str], group: Sequence[str] = (), labels: Sequence[str] | None = None) -> DataFrame:
    """AG24: mean per time point, one column per group value or metric, sorted by time."""
    if group and len(metrics) > 1:
        raise QueryError("a grouped time table takes one metric")
    if group:
        wide = pivot(df, [time], group, {metrics[0]: (metrics[0], "mean")}, labels=labels)
        prefix = escape_label(metrics[0]) + LABEL_SEPARATOR
        wide = wide.withColumnsRenamed({c: c.removeprefix(prefix) for c in wide.columns})
    else:
        wide = aggregate(df, [time], {m: (m, "mean") for m in metrics})
    return wide.orderBy(F.col(time).desc())


def shares(df: DataFrame, value: str, over: Sequence[str], target: str = "share") -> DataFrame:
    """A value over the total of its row, column or the whole table."""
    if not over:
        return contribution(df, "column", [value], [target])
    totals = df.groupBy(*over).agg(F.sum(value).cast("double").alias("__t"))
    joined = join_null_safe(df, totals, over, "left")
    return joined.withColumn(target, F.try_divide(F.col(value).cast("double"), F.col("__t"))).drop("__t")
