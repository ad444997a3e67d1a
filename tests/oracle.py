"""Runs a registered query and its SQL side by side. ``python tests/oracle.py [-s SF] [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


#: Queries that SQL cannot state, and what holds their results instead; any other query without SQL fails.
HELD_BY = {
    "op1_decontamination": "tests/llm/test_operators.py: edit distances and planted copies against tables",
    "op2_toxicity": "tests/llm/test_operators.py: held-out accuracy",
    "op3_near_duplicates": "tests/llm/test_operators.py: all pairs",
    "op4_language": "tests/llm/test_operators.py: held-out accuracy",
    "op6_pieces": "tests/llm/test_operators.py: the SentencePiece library",
    "op7_secrets": "tests/llm/test_operators.py: base spans by pattern, planted random strings",
    "op8_html_text": "tests/llm/test_operators.py: pages written for it",
    "op9_quality": "tests/llm/test_operators.py: held-out accuracy",
    "op10_fingerprints": "tests/llm/test_operators.py: weighted Jaccard similarity, edited texts",
    "op12_token_files": "tests/llm/test_token_files.py: the tokenizers library, round trips",
    "pipeline": "tests/llm/test_operators.py: subsets and counts of each stage, not brute force",
}


def folder(sf: str = "0.01") -> str:
    return f"/root/testdata/sf{sf}"


def connection(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or value is pd.NaT:
        return "∅"
    if isinstance(value, float):
        if math.isnan(value):
            return "∅"
        return f"{value + 0.0:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.6f}"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "as_tuple"):
        return f"{float(value):.6f}"
    return str(value)


def _kind(name: str) -> str:
    name = name.lower()
    for kind, starts in {
        "int": ("bigint", "int", "smallint", "tinyint", "number"),
        "float": ("double", "float"),
        "text": ("varchar", "string"),
        "bool": ("bool",),
        "time": ("timestamp", "datetime"),
    }.items():
        if name.startswith(starts):
            return kind
    return name


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, path: str, run, sql: str | None, name: str = "") -> tuple[bool, str]:
    df = run(spark, path)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return name in HELD_BY, f"{len(mine)} rows, no SQL; held by {HELD_BY.get(name, 'nothing')}"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    odd = {f.name: (_kind(f.dataType.simpleString()), kinds[f.name]) for f in df.schema.fields}
    odd = {k: v for k, v in odd.items() if v[0] != v[1]}
    if odd:
        return False, f"types {odd}"
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if a == b:
        return True, f"{len(a)} rows"
    odd = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return False, f"{len(a)} vs {len(b)} rows; {odd}"


def main() -> int:
    import __spark_entry__ as entry_module

    from millrace.session import build_session

    args = [a for a in sys.argv[1:] if a != "-v"]
    sf = "0.01"
    if args[:1] == ["-s"]:
        sf, args = args[1], args[2:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.session.timeZone": os.environ.get("ZONE", "UTC"), "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    path = folder(sf)
    con = connection(path)
    queries, sqls, bad = entry_module.queries(), entry_module.oracle_sql(), 0
    for name, run in queries.items():
        if args and not any(name == a or (a.endswith("*") and name.startswith(a[:-1])) for a in args):
            continue
        started = time.time()
        try:
            ok, note = compare(spark, con, path, run, sqls.get(name), name)
        except Exception as problem:  # noqa: BLE001
            ok, note = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += not ok
        if not ok or "-v" in sys.argv or note.startswith("0 rows"):
            print("ok  " if ok else "FAIL", name, f"{time.time() - started:.1f}s", note, flush=True)
    print(f"{bad} failing of {len(queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
