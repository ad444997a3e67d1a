"""Post-processing steps by name: a query's list of (name, options) applied in order."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from millrace.errors import QueryError
from millrace.operators import aggregates, geo, ordering, pivots, project, series, stats

STEPS: dict[str, Callable[..., DataFrame]] = {
    "aggregate": aggregates.aggregate,
    "boxplot": stats.boxplot,
    "compare": series.compare,
    "contribution": aggregates.contribution,
    "cum": series.cumulative,
    "densify": series.densify,
    "diff": series.diff,
    "flatten": pivots.flatten,
    "forecast": series.forecast,
    "escape_names": project.escape_names,
    "geohash_decode": geo.from_geohash,
    "geohash_encode": geo.to_geohash,
    "geohash_grid": geo.geohash_grid,
    "pivot": pivots.pivot,
    "rename": project.rename_op,
    "resample": series.resample,
    "rolling": series.rolling,
    "select": project.select_op,
    "sort": ordering.sort_op,
    "unescape_names": project.unescape_names,
}


def apply_step(df: DataFrame, name: str, options: Mapping[str, object]) -> DataFrame:
    if name not in STEPS:
        raise QueryError(f"unknown post-processing step: {name}")
    return STEPS[name](df, **options)
