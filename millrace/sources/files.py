"""Delimited and columnar files (SC11, SC12, SC15, SU2)."""

from __future__ import annotations

import csv
import io
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions.text import guard_cell
from millrace.operators.joins import dedup_names

# Declared column types and what they load as.
DECLARED_TYPES = {
    "VARCHAR": "string",
    "STRING": "string",
    "TEXT": "string",
    "BOOLEAN": "boolean",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "FLOAT": "double",
    "DOUBLE": "double",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp_ntz",
}


def _mangled(names: Sequence[str]) -> list[str]:
    """Repeated headers become ``a, a.1, a.2``."""
    return [n.replace("__", ".") if n not in names else n for n in dedup_names(names)]


#: Stand for a quoted empty cell, told so from a missing one, and for a line break while a record is parsed: private-use
#: characters.
_EMPTY, _LINE = "\ue0f8", "\ue0f9"


def _header(spark: SparkSession, path: str, sep: str, skip_rows: int) -> list[str]:
    """The names in the first record below ``skip_rows`` lines; a quoted name may hold separators and line breaks."""
    lines = spark.read.text(path).where(F.col("_metadata.file_block_start") == 0)
    size = skip_rows + 1
    while True:
        found = [r[0] for r in lines.limit(size).collect()]
        record = "\n".join(found[skip_rows:])
        if record.count('"') % 2 == 0 or len(found) < size:
            break
        size *= 2
    if len(found) <= skip_rows:
        raise QueryError("the file has no header line")
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=sep, skipinitialspace=True))


def csv_records(spark: SparkSession, paths: Sequence[str], skip_rows: int = 0) -> DataFrame:
    """(file, number, value): the records of delimited files, numbered in each file; quoted cells may hold line breaks.

    Files are split into blocks as usual. A line break ends a record where the number of quotes before it is even, so
    blocks count their quotes and their records for either state, one row a block; sums over the blocks before tell the
    state and the number each block begins with. Only records of several lines are gathered. Blank lines between
    records, and the first ``skip_rows`` lines of each file, are left out.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    if skip_rows:
        firsts = lines.where("start = 0").groupBy(F.col("file").alias("f")).agg(F.min("row").alias("first"))
        lines = lines.join(firsts, F.col("file") == F.col("f"), "left")
        lines = lines.where((F.col("start") > 0) | (F.col("row") - F.col("first") >= skip_rows)).drop("f", "first")
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    block = W.partitionBy("file", "start").orderBy("row")
    before = F.coalesce(F.sum("odd").over(block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) % 2
    filled = F.trim("value") != ""
    lines = lines.withColumn("odd", quotes % 2).withColumns({"inside": before, "filled": filled})
    blocks = lines.groupBy("file", "start").agg(
        (F.sum("odd") % 2).alias("odd"),
        F.count_if(F.col("filled") & (F.col("inside") == 0)).alias("outer"), F.count_if(F.col("filled") & (F.col("inside") == 1)).alias("inner"),
    )
    earlier = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("state", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("state") == 0, F.col("outer")).otherwise(F.col("inner"))
    blocks = blocks.withColumn("begun", F.coalesce(F.sum(begun).over(earlier), F.lit(0)))
    blocks = blocks.select(F.col("file").alias("f"), F.col("start").alias("s"), "state", "begun")
    lines = lines.join(blocks, (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")))
    within = (F.col("inside") + F.col("state")) % 2 == 1
    lines = lines.withColumn("within", within).withColumn("begins", F.col("filled") & ~F.col("within"))
    lines = lines.where("within OR begins")
    number = F.col("begun") + F.sum(F.col("begins").cast("bigint")).over(block.rowsBetween(W.unboundedPreceding, 0)) - 1
    lines = lines.select("file", "start", "row", "value", number.alias("number"), (F.col("begins") & (F.col("odd") == 0)).alias("whole"))
    parts = lines.where("NOT whole").groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("start", "row", "value"))).alias("lines"))
    joined = F.array_join(F.transform("lines", lambda r: r["value"]), "\n")
    return lines.where("whole").select("file", "number", "value").unionByName(parts.select("file", "number", joined.alias("value")))


def load_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    skip_rows: int = 0,
    null_values: Sequence[str] = (),
    skip_initial_space: bool = False,
    max_rows: int | None = None,
    columns: Sequence[str] | None = None,
    dates: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """SC11: delimited text (also gzip). Columns load as text unless ``types`` declares them.

    The header is read from the first file; every file has it, below ``skip_rows`` other lines. Quotes in quoted cells
    are doubled; quoted cells and names may hold separators and line breaks (read as \\n). A quoted empty cell is empty
    text, a missing one null. Files are split over tasks as usual.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for declared in (types or {}).values():
        if declared.upper() not in DECLARED_TYPES:
            raise QueryError(f"unknown column type: {declared}")
    names = _mangled([n.strip() for n in _header(spark, paths[0], sep, skip_rows)])
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "quote": '"', "escape": '"', "emptyValue": _EMPTY, "maxCharsPerColumn": "-1", "ignoreLeadingWhiteSpace": str(skip_initial_space).lower()}
    data = csv_records(spark, paths, skip_rows).where("number > 0")
    df = data.select(F.from_csv(F.replace("value", F.lit("\n"), F.lit(_LINE)), F.lit(fields), options).alias("r"))
    cells = [F.col(f"r.c{i}") for i in range(len(names))]
    cells = [F.when(c == _EMPTY, F.lit("")).otherwise(F.replace(c, F.lit(_LINE), F.lit("\n"))) for c in cells]
    df = df.select(*[c.alias(n) for c, n in zip(cells, names)])
    for name in columns or ():
        if name not in names:
            raise QueryError(f"no such column: {name}")
    df = df.select(*[F.col(f"`{c}`") for c in (columns or names)])
    for null in null_values:
        df = df.replace(null, None)
    converted = {}
    for name in df.columns:
        if types and name in types:
            converted[name] = F.col(f"`{name}`").try_cast(DECLARED_TYPES[types[name].upper()])
        elif name in dates:
            converted[name] = F.col(f"`{name}`").try_cast("timestamp_ntz")
    df = df.withColumns(converted) if converted else df
    return df.limit(max_rows) if max_rows is not None else df


def load_columnar(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """SC12: several parquet files as one frame, optionally some columns."""
    df = spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)
    return df.select(*columns) if columns else df


def csv_safe(df: DataFrame) -> DataFrame:
    """SC15: text cells and headers a spreadsheet would execute are neutralised."""
    cells = [
        (guard_cell(f"`{f.name}`") if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`")).alias(_safe_name(f.name))
        for f in df.schema.fields
    ]
    return df.select(*cells)


def _safe_name(name: str) -> str:
    risky = name.lstrip()[:1] in tuple("-@+|=%") and (name[:1] != "-" or not name[1:].replace(".", "").isdigit())
    return "'" + name.replace("|", "\\|") if risky and name else name


def export_csv(df: DataFrame, path: str) -> None:
    """SC15: one folder of CSV part files, written in parallel; ``load_csv`` reads them back as they were."""
    options = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    csv_safe(df).write.mode("errorifexists").options(**options).csv(path)


def concat_clean(frames: Sequence[DataFrame], column: str | None = None) -> DataFrame:
    """SU2: frames one after another, rows with any null dropped; optionally one column's values."""
    union = frames[0]
    for other in frames[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    clean = union.dropna("any")
    return clean.select(column).distinct() if column else clean
