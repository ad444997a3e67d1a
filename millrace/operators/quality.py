"""Data quality (AG34-AG37): one aggregate pass, then a tall table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import QueryError
from millrace.operators.filters import generic_type
from millrace.session import cut_lineage


def _tall(one_row: DataFrame, cells: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(entity, instance, name, column of ``one_row``) to rows."""
    rows = [
        F.struct(
            F.lit(e).alias("entity"), F.lit(i).alias("instance"), F.lit(n).alias("name"), F.col(c).cast("double").alias("value")
        )
        for e, i, n, c in cells
    ]
    return one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _completeness(col: str) -> Column:
    return F.try_divide(F.count(col).cast("double"), F.count(F.lit(1)).cast("double"))


def quality_metrics(df: DataFrame, complete: Sequence[str] = (), means: Sequence[str] = ()) -> DataFrame:
    """AG34: Size, Completeness and Mean as (entity, instance, name, value)."""
    aggs = [F.count(F.lit(1)).alias("size")]
    cells = [("Dataset", "*", "Size", "size")]
    for i, c in enumerate(complete):
        aggs.append(_completeness(c).alias(f"c{i}"))
        cells.append(("Column", c, "Completeness", f"c{i}"))
    for i, c in enumerate(means):
        aggs.append(F.avg(c).alias(f"m{i}"))
        cells.append(("Column", c, "Mean", f"m{i}"))
    return _tall(df.agg(*aggs), cells)


# Checks and what breaks them.
_VIOLATIONS = {
    "isComplete": lambda c: c.isNull(),
    "isPositive": lambda c: ~F.coalesce(c > 0, F.lit(True)),
    "isNonNegative": lambda c: ~F.coalesce(c >= 0, F.lit(True)),
}


def quality_checks(df: DataFrame, checks: Sequence[tuple[str, str]], level: str = "Warning") -> DataFrame:
    """AG35: (constraint, column) pairs to rows with violations and a status."""
    for name, _ in checks:
        if name not in _VIOLATIONS:
            raise QueryError(f"unknown check: {name}")
    counted = df.agg(*[F.count_if(_VIOLATIONS[n](F.col(c))).alias(f"v{i}") for i, (n, c) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(level).alias("check_level"),
            F.lit(f"{n}({c})").alias("check_name"),
            F.col(f"v{i}").alias("violations"),
            F.when(F.col(f"v{i}") == 0, F.lit("Success")).otherwise(F.lit("Failure")).alias("status"),
        )
        for i, (n, c) in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


#: Size of the distinct-value sketch (2^14 registers) and three standard errors of its estimate, as a share.
DISTINCT_BITS, DISTINCT_ERROR = 14, 0.025
#: Size of the quantile sketch, and how far a value's share of smaller rows may be from the one asked for.
QUANTILE_SIZE, QUANTILE_ERROR = 800, 0.008
_QUARTILES = (0.25, 0.5, 0.75)


def _distinct_sketch(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    kind = field.dataType.simpleString()
    fits = col.cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else col if kind == "binary" else col.cast("string")
    return F.hll_sketch_agg(fits, DISTINCT_BITS)


def _profiled(schema: T.StructType, columns: Sequence[str] | None) -> list[tuple[int, T.StructField, bool]]:
    """(number, field, whether it is a number) of the columns to profile."""
    fields = [f for f in schema.fields if columns is None or f.name in columns]
    return [(i, f, generic_type(f.dataType) == "NUMERIC") for i, f in enumerate(fields)]


def profile_sketches(df: DataFrame, parts: Sequence[str] = (), columns: Sequence[str] | None = None, approximate: bool = True) -> DataFrame:
    """AG36, first half: one row per part with counts, moments and binary sketches of each column.

    The rows can be stored and merged with those of other parts of the data by ``merged_profile``, in any order.
    """
    aggs = [F.count(F.lit(1)).alias("size")]
    for i, f, number in _profiled(df.schema, columns):
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"n{i}"))
        if approximate:
            aggs.append(_distinct_sketch(f).alias(f"d{i}"))
        if number:
            x = c.cast("double")
            aggs += [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"), F.avg(x).alias(f"mean{i}"), F.sum(x).alias(f"sum{i}")]
            aggs.append((F.var_pop(x) * F.count(c)).alias(f"apart{i}"))
            if approximate:
                aggs.append(F.kll_sketch_agg_double(x, QUANTILE_SIZE).alias(f"q{i}"))
    return df.groupBy(*parts).agg(*aggs)


def merged_profile(sketches: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None, approximate: bool = True) -> DataFrame:
    """AG36, second half: the profile of all parts together, one row per column of ``schema``.

    ``approx_distinct`` is within ``DISTINCT_ERROR`` of the distinct values, the share of rows below a quartile within
    ``QUANTILE_ERROR`` of its own, each but for a few in a thousand cases.
    """
    profiled = _profiled(schema, columns)
    aggs = [F.sum("size").alias("size")]
    for i, _, number in profiled:
        aggs.append(F.sum(f"n{i}").alias(f"n{i}"))
        if approximate:
            aggs.append(F.hll_sketch_estimate(F.hll_union_agg(f"d{i}")).alias(f"d{i}"))
        if number:
            n, mean = F.col(f"n{i}"), F.col(f"mean{i}")
            aggs += [F.min(f"min{i}").alias(f"min{i}"), F.max(f"max{i}").alias(f"max{i}"), F.sum(f"sum{i}").alias(f"sum{i}")]
            # within the parts, and between their means
            aggs.append((F.sum(f"apart{i}") + F.sum(n * mean * mean) - F.try_divide(F.sum(f"sum{i}") * F.sum(f"sum{i}"), F.sum(n).cast("double"))).alias(f"apart{i}"))
            if approximate:
                aggs.append(F.kll_merge_agg_double(f"q{i}").alias(f"q{i}"))
    one = sketches.agg(*aggs)
    rows = []
    for i, f, number in profiled:
        n, nothing = F.col(f"n{i}").cast("double"), F.lit(None).cast("double")
        cells = [
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.try_divide(n, F.col("size").cast("double")).alias("completeness"),
        ]
        if approximate:
            cells.append(F.col(f"d{i}").alias("approx_distinct"))
            asked = F.array(*[F.lit(p) for p in _QUARTILES])
            found = F.when(n > 0, F.kll_sketch_get_quantile_double(f"q{i}", asked)) if number else F.lit(None).cast("array<double>")
            cells.append(found.alias("quartiles"))
        if number:
            values = [F.col(f"min{i}"), F.col(f"max{i}"), F.try_divide(F.col(f"sum{i}"), n), F.col(f"sum{i}")]
            values.append(F.sqrt(F.greatest(F.try_divide(F.col(f"apart{i}"), n), F.lit(0.0))))
        cells += [(values[j] if number else nothing).alias(name) for j, name in enumerate(("min", "max", "mean", "sum", "std"))]
        rows.append(F.struct(*cells))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def column_profile(df: DataFrame, approximate: bool = True, columns: Sequence[str] | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """AG36: per column type, completeness, approximate distinct values and quartiles, and number statistics.

    Each part of the data (all of it without ``parts``) is sketched, and the sketches are merged.
    """
    return merged_profile(profile_sketches(df, parts, columns, approximate), df.schema, columns, approximate)


def checked_profile(df: DataFrame, columns: Sequence[str] | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """The profile with exact distinct values beside the sketches, and whether these kept their stated error."""
    profile = cut_lineage(column_profile(df, True, columns, parts))
    profiled = _profiled(df.schema, columns)
    known = {r["column"]: r["quartiles"] for r in profile.select("column", "quartiles").collect()}  # one row a column
    aggs = []
    for i, f, _ in profiled:
        c = F.col(f"`{f.name}`")
        aggs.append(F.count_distinct(c).alias(f"e{i}"))
        for j, q in enumerate(known[f.name] or ()):
            x = c.cast("double")
            aggs += [F.avg((x < q).cast("double")).alias(f"below{i}_{j}"), F.avg((x <= q).cast("double")).alias(f"upto{i}_{j}")]
    one = df.agg(*aggs)
    rows = []
    for i, f, _ in profiled:
        kept = F.lit(True) if known[f.name] else F.lit(None).cast("boolean")
        for j in range(len(known[f.name] or ())):
            kept &= (F.col(f"below{i}_{j}") <= _QUARTILES[j] + QUANTILE_ERROR) & (F.col(f"upto{i}_{j}") >= _QUARTILES[j] - QUANTILE_ERROR)
        rows.append(F.struct(F.lit(f.name).alias("column"), F.col(f"e{i}").alias("distinct"), kept.alias("quartiles_within")))
    exact = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    near = F.abs(F.col("approx_distinct") - F.col("distinct")) <= F.greatest(F.lit(DISTINCT_ERROR) * F.col("distinct"), F.lit(1))
    return profile.join(exact, "column").withColumn("distinct_within", near)


# Our thresholds: a column this complete is worth a completeness rule, a column with this share of
# distinct values is taken as unique.
RETAIN_COMPLETENESS = 0.2
UNIQUE_SHARE = 0.95


def suggest_constraints(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AG37: rules the data suggests, from one profiling pass.

    complete columns stay complete; mostly filled columns keep their completeness (95 % lower
    bound); numbers without negatives stay non-negative; text that reads as numbers keeps its
    type; (nearly) unique columns stay unique. Distinct values are estimated by sketches; columns whose
    estimate is within its error of the threshold are counted exactly in a second pass.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    aggs = [F.count(F.lit(1)).alias("size")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"n{i}"), F.hll_sketch_estimate(_distinct_sketch(f)).alias(f"d{i}")]
        kind = generic_type(f.dataType)
        if kind == "NUMERIC":
            aggs.append(F.count_if(c < 0).alias(f"neg{i}"))
        elif f.dataType.simpleString() == "string":
            aggs.append(F.count_if(c.rlike(r"^-?\d+(\.\d+)?$")).alias(f"num{i}"))
    one = cut_lineage(df.agg(*aggs))
    row = one.first()
    doubtful = [i for i in range(len(fields)) if abs(row[f"d{i}"] - UNIQUE_SHARE * row[f"n{i}"]) <= DISTINCT_ERROR * row[f"n{i}"]]
    if doubtful:
        counts = df.agg(*[F.count_distinct(F.col(f"`{fields[i].name}`")).alias(f"d{i}") for i in doubtful]).first()
        one = one.withColumns({f"d{i}": F.lit(counts[f"d{i}"]) for i in doubtful})
    rules = []

    def rule(when: Column, column: str, name: str, detail: Column) -> Column:
        body = F.struct(F.lit(column).alias("column"), F.lit(name).alias("rule"), detail.alias("constraint"))
        return F.when(when, body)

    for i, f in enumerate(fields):
        n, size = F.col(f"n{i}").cast("double"), F.col("size").cast("double")
        share = F.try_divide(n, size)
        rules.append(rule(F.col(f"n{i}") == F.col("size"), f.name, "CompleteIfComplete", F.lit(f"{f.name} is not null")))
        bound = share - 1.96 * F.sqrt(F.try_divide(share * (1 - share), size))
        rules.append(
            rule(
                (share > RETAIN_COMPLETENESS) & (share < 1), f.name, "RetainCompleteness",
                F.concat(F.lit(f"completeness({f.name}) >= "), F.format_number(bound, 2)),
            )
        )
        rules.append(
            rule(
                (n > 0) & (F.col(f"d{i}") >= UNIQUE_SHARE * n), f.name, "UniqueIfApproximatelyUnique",
                F.lit(f"{f.name} is unique"),
            )
        )
        if generic_type(f.dataType) == "NUMERIC":
            rules.append(rule((n > 0) & (F.col(f"neg{i}") == 0), f.name, "NonNegativeNumbers", F.lit(f"{f.name} >= 0")))
        elif f.dataType.simpleString() == "string":
            rules.append(rule((n > 0) & (F.col(f"num{i}") == F.col(f"n{i}")), f.name, "RetainType", F.lit(f"{f.name} is numeric")))
    return one.select(F.explode(F.array_compact(F.array(*rules))).alias("r")).select("r.*")


