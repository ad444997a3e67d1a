"""Mergeable sketches, the far tail of Student's distribution, and delimited files with line breaks."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality, stats
from millrace.sources import files


def test_sketches_merge_to_the_same_profile(spark):
    df = spark.range(6000).select(
        (F.col("id") % 7).alias("part"), F.col("id"), (F.col("id") % 900).cast("string").alias("name"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 1000).cast("double")).alias("x"), F.lit(None).cast("double").alias("none"),
    )
    columns = ["id", "name", "x", "none"]
    stored = quality.profile_sketches(df, ["part"], columns)
    merged = {r["column"]: r for r in quality.merged_profile(stored, df.schema, columns).collect()}
    whole = {r["column"]: r for r in quality.column_profile(df, columns=columns).collect()}
    for name in columns:
        a, b = merged[name], whole[name]
        assert a["completeness"] == b["completeness"] and a["approx_distinct"] == pytest.approx(b["approx_distinct"], rel=0.02)
        for stat in ("min", "max", "sum", "mean", "std"):
            assert a[stat] == (b[stat] if b[stat] is None else pytest.approx(b[stat]))
    assert merged["x"]["std"] == pytest.approx(df.agg(F.stddev_pop("x")).first()[0])
    assert merged["none"]["quartiles"] is None and merged["name"]["approx_distinct"] == pytest.approx(900, rel=quality.DISTINCT_ERROR)
    checked = {r["column"]: r for r in quality.checked_profile(df, columns, ["part"]).collect()}
    assert all(r["distinct_within"] for r in checked.values()) and checked["x"]["quartiles_within"] and checked["name"]["distinct"] == 900


def test_columns_near_the_threshold_are_counted(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1899, F.col("id")).otherwise(0).alias("under"), F.when(F.col("id") < 1901, F.col("id")).otherwise(0).alias("over"))
    unique = {r["column"] for r in quality.suggest_constraints(df).collect() if r["rule"] == "UniqueIfApproximatelyUnique"}
    assert unique == {"over"}


# Reference values: exact for 1 and 2 degrees of freedom, published tables and normal tails for the others.
@pytest.mark.parametrize("t, freedom, p", [
    (0.0, 5, 1.0), (1.0, 1, 0.5), (2.0, 2, 1 - 2 / 6**0.5), (1e6, 1, 6.366197723673e-07), (40.0, 2, 1 - 40 / 1602**0.5), (2.228139, 10, 0.05),
    (3.169273, 10, 0.01), (1.959964, 10_000_000, 0.05), (40.0, 10_000_000, 7.32e-350), (8.0, 10_000_000, 1.2442e-15), (1.0, 10_000_000, 0.3173105),
])
def test_student_tail(spark, t, freedom, p):
    got = spark.range(1).select(stats.student_two_sided(F.lit(t), F.lit(freedom))).first()[0]
    assert got == pytest.approx(p, rel=2e-4, abs=1e-300)


def test_student_tail_against_its_finite_sum(spark):
    import math

    def finite(t, v):
        angle = math.atan(abs(t) / math.sqrt(v))
        term = total = math.cos(angle) if v % 2 else 1.0
        for i in range(1, (v - v % 2) // 2):
            term *= math.cos(angle) ** 2 * (2 * i - 1 + v % 2) / (2 * i + v % 2)
            total += term
        inside = 2 / math.pi * (angle + (math.sin(angle) * total if v > 1 else 0)) if v % 2 else math.sin(angle) * total
        return 1 - inside

    cases = [(t, v) for t in (0.01, 0.5, 1.0, 1.7, 1.8, 3.0, 6.0) for v in (1, 2, 3, 4, 7, 30, 101, 500)]
    df = spark.createDataFrame(cases, "t double, v long").select("t", "v", stats.student_two_sided(F.col("t"), F.col("v")).alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(finite(r["t"], r["v"]), abs=2e-13)


CELLS = ["", None, "a,b", 'say "x"', "line\nbreak", '\n\n"', '"', "plain", ' lead', "é\n,", '""', '",\n"']


def test_nested_cells_in_small_blocks(spark, tmp_path):
    rng = random.Random(2)
    rows = [(str(i), rng.choice(CELLS), rng.choice(CELLS)) for i in range(400)]
    files.export_csv(spark.createDataFrame(rows, 'id string, `x, "y"` string, `two\nlines` string').repartition(2), str(tmp_path / "out"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        out = files.load_csv(spark, str(tmp_path / "out"))
        assert out.columns == ["id", 'x, "y"', "two\nlines"]
        assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted(rows, key=repr)
        assert files.csv_records(spark, [str(tmp_path / "out")]).select("file", "number").distinct().count() == 400 + len({r[0] for r in files.csv_records(spark, [str(tmp_path / "out")]).select("file").collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_of_a_hand_written_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    with path.open("w", newline="") as out:
        out.write("made by hand, with a \" quote\"\n")
        csv.writer(out, delimiter=";").writerows([["id", "note;x"], ["1", "a;b"], ["2", 'he said "no"\nand left'], ["3", ""]])
        out.write("\n4;last\n")
    got = files.load_csv(spark, str(path), sep=";", skip_rows=1, types={"id": "BIGINT"})
    assert got.columns == ["id", "note;x"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a;b"), (2, 'he said "no"\nand left'), (3, None), (4, "last")]
