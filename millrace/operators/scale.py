"""Building blocks that keep one hot group from landing in one task.

* ``ranked_counts``  exact order statistics of arbitrarily large groups: values are first
  folded to (group, value, count), cut into value ranges, counted inside each range in
  parallel, and the ranges are stitched together with their running totals.
* ``chunk_of``       value -> range number, as a binary decision over literal split points.
* ``numbered``       places in a total order: ranges are sorted in parallel, their sizes added up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.session import chunk_count, cut_lineage


def split_points(df: DataFrame, col: str, pieces: int | None = None) -> list:
    """At most ``pieces - 1`` ordered cut values of a numeric column (one small driver result).

    The cuts only balance the work; any cuts give the same answer.
    """
    pieces = pieces or chunk_count(df.sparkSession)
    probs = [i / pieces for i in range(1, pieces)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, max(1_000, 10 * pieces))).first()
    return sorted(set(row[0] or []))


def chunk_of(col: Column, cuts: Sequence[float]) -> Column:
    """Index of the range holding ``col``: a balanced tree of comparisons, all generated code."""

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(col < F.lit(cuts[middle]), branch(low, middle)).otherwise(branch(middle + 1, high))

    return branch(0, len(cuts))


def ranked_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Per (group, distinct non-null value): ``n`` copies, ``below`` rows under it, ``total`` rows.

    Memory per task is one (group, value-range) piece of the folded values.
    """
    groups = list(groups)
    known = df.where(F.col(value).isNotNull())
    cuts = split_points(known, value)
    folded = (
        known.groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__piece", chunk_of(F.col(value).cast("double"), cuts))
    )
    # at most len(cuts) + 1 rows per group from here on
    pieces = folded.groupBy(*groups, "__piece").agg(F.sum("n").alias("__in_piece"))
    per_group = W.partitionBy(*(groups or [F.lit(0)]))
    earlier = per_group.orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(
        *groups,
        "__piece",
        F.coalesce(F.sum("__in_piece").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__in_piece").over(per_group).alias("total"),
    )
    inside = (
        W.partitionBy(*groups, "__piece").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    )
    local = folded.withColumn("__local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = join_null_safe(local, pieces, [*groups, "__piece"], "inner")
    return joined.select(
        *groups, value, "n", (F.col("__before") + F.col("__local")).alias("below"), "total"
    )


def quantile_columns(
    ranked_value: str, wanted: Mapping[str, tuple[float, str]]
) -> list[Column]:
    """Aggregates over ``ranked_counts`` rows giving exact quantiles.

    ``wanted`` maps an output name to (probability, "linear" | "midpoint").
    """
    out = []
    for name, (prob, how) in wanted.items():
        place = F.lit(float(prob)) * (F.col("total") - 1)
        low, high = F.floor(place), F.ceil(place)

        def at(rank: Column) -> Column:
            here = (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))
            return F.max(F.when(here, F.col(ranked_value).cast("double")))

        if how == "midpoint":
            value = (at(low) + at(high)) / 2
        else:
            part = F.max(place - low)
            value = at(low) + (at(high) - at(low)) * part
        out.append(value.alias(name))
    return out


def group_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, wanted: Mapping[str, tuple[float, str]]
) -> DataFrame:
    """Exact quantiles per group; groups without a known value do not appear."""
    ranked = ranked_counts(df, groups, value)
    return ranked.groupBy(*groups).agg(*quantile_columns(value, wanted))


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, pieces: int | None = None) -> DataFrame:
    """Adds ``name``: each row's place, from 0, in the total order; no task sees more than one range of it.

    Rows are dealt by ranges of ``order`` and sorted inside them; Spark's row ids then hold the range and the place
    in it. The dealt rows are settled once, so that counts and rows come from the same ranges. Only one count per
    range is added up in one place. Make ``order`` total, or a lost executor may swap equal rows.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    dealt = cut_lineage(dealt.withColumn("__numbered_row", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("__numbered_range", F.shiftright("__numbered_row", 33))
    sizes = dealt.groupBy("__numbered_range").agg(F.count(F.lit(1)).alias("__numbered_size"))
    earlier = W.partitionBy(F.lit(0)).orderBy("__numbered_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__numbered_range", F.coalesce(F.sum("__numbered_size").over(earlier), F.lit(0)).alias("__numbered_before"))
    place = F.col("__numbered_before") + F.col("__numbered_row").bitwiseAND(F.lit((1 << 33) - 1))
    # at most ``pieces`` rows
    return dealt.join(F.broadcast(offsets), "__numbered_range").select(*df.columns, place.alias(name))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``<=>`` keeping the left key columns only."""
    keys = list(keys)
    if not keys:
        # one-row right side: fold it in as scalar values, no cross join
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"__r_{key}"])
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def most_labels(spark: SparkSession) -> int:
    """How many labels may become columns without being given: Spark's own bound on pivots."""
    return int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))


def bounded_labels(rows: DataFrame) -> list:
    """The rows of a label list that fits a wide table; more is an error, since the long form holds any number."""
    most = most_labels(rows.sparkSession)
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise QueryError(f"more than {most} labels would become columns: take the long form, or give the labels")
    return found


def pivot_values(df: DataFrame, label: str) -> list:
    """Sorted distinct labels: the columns of a wide result."""
    rows = bounded_labels(df.select(label).distinct())
    return sorted((r[0] for r in rows), key=lambda v: (v is None, v))
