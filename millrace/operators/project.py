"""Projections (PR1-PR3, PR11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import QueryError
from millrace.functions.text import escape_label, unescape_label


def project(df: DataFrame, columns: Sequence[str | tuple[str, str]], time_col: str | None = None) -> DataFrame:
    """PR1: names or (label, SQL) pairs; a repeated label is kept once; the time column leads."""
    chosen: dict[str, object] = {}
    for item in columns:
        label, sql = (item, None) if isinstance(item, str) else item
        if label not in chosen:
            chosen[label] = (F.col(label) if sql is None else F.expr(sql)).alias(label)
    labels = sorted(chosen, key=lambda label: label != time_col)
    return df.select(*[chosen[label] for label in labels])


def select_op(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """PR2: select, then drop, then rename."""
    for name in [*(columns or ()), *(exclude or ())]:
        if name not in df.columns:
            raise QueryError(f"no such column: {name}")
    if columns:
        df = df.select(*columns)
    if exclude:
        df = df.drop(*exclude)
    for name in rename or ():
        if name not in df.columns:
            raise QueryError(f"no such column: {name}")
    return df.withColumnsRenamed(dict(rename)) if rename else df


def rename_op(df: DataFrame, mapping: Mapping[str, str | None], level: int | None = None) -> DataFrame:
    """PR3: rename columns; with ``level`` rename one part of flat ``metric, series`` labels.

    ``None`` as the new name drops that part of the label.
    """
    if not mapping:
        return df
    if level is None:
        missing = set(mapping) - set(df.columns)
        if missing:
            raise QueryError(f"no such column: {sorted(missing)}")
        if all(new in df.columns for new in mapping.values()):
            raise QueryError("all the new labels are taken")
        return df.withColumnsRenamed({k: v for k, v in mapping.items() if v is not None})
    parts_of = {c: c.split(", ") for c in df.columns}
    known = {p[level] for p in parts_of.values() if len(p) > level}
    if not set(mapping) <= known:
        raise QueryError(f"no such label: {sorted(set(mapping) - known)}")
    if all(new in known for new in mapping.values()):
        raise QueryError("all the new labels are taken")
    renames = {}
    for column, parts in parts_of.items():
        if len(parts) > level and parts[level] in mapping and len(parts) > 1:
            new = mapping[parts[level]]
            kept = parts[:level] + ([] if new is None else [new]) + parts[level + 1 :]
            renames[column] = ", ".join(kept)
    return df.withColumnsRenamed(renames)


def expand_nested(df: DataFrame) -> DataFrame:
    """PR11: arrays become rows, structs become dotted columns, breadth-first.

    Parallel arrays of one level share rows; on the extra rows every other column is null.
    """
    order = list(df.columns)
    while True:
        nested = {f.name: f.dataType for f in df.schema.fields}
        structs = [c for c in order if isinstance(nested[c], T.StructType)]
        if structs:
            selected, new_order = [], []
            for c in order:
                if c in structs:
                    for child in nested[c].fields:
                        name = f"{c}.{child.name}"
                        selected.append(F.col(f"`{c}`").getField(child.name).alias(name))
                        new_order.append(name)
                else:
                    selected.append(F.col(f"`{c}`"))
                    new_order.append(c)
            df, order = df.select(*selected), new_order
            continue
        arrays = [c for c in order if isinstance(nested[c], T.ArrayType)]
        if not arrays:
            return df
        # positional names survive arrays_zip even when columns carry dots
        zipped = F.arrays_zip(
            *[F.coalesce(F.col(f"`{c}`"), F.array().cast(nested[c])).alias(f"a{i}") for i, c in enumerate(arrays)]
        )
        row = df.select("*", zipped.alias("__zip"))
        row = row.select("*", F.posexplode_outer("__zip").alias("__pos", "__item"))
        fields = [f.name for f in row.schema["__item"].dataType.fields]
        first = F.coalesce(F.col("__pos"), F.lit(0)) == 0
        selected = []
        for c in order:
            if c in arrays:
                selected.append(F.col("__item").getField(fields[arrays.index(c)]).alias(c))
            else:
                selected.append(F.when(first, F.col(f"`{c}`")).alias(c))
        df = row.select(*selected)


def escape_names(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Separators inside column names are escaped, so that names can be joined into flat labels."""
    return df.withColumnsRenamed({c: escape_label(c) for c in (df.columns if columns is None else columns)})


def unescape_names(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The inverse of ``escape_names``."""
    return df.withColumnsRenamed({c: unescape_label(c) for c in (df.columns if columns is None else columns)})
