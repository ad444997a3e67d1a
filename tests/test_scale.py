"""Exact order statistics under skew, and the plans that keep hot keys out of single tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import changes, scale, series


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    rows = [("hot", float(v)) for v in rng.normal(size=4000).round(3)]
    rows += [("hot", 0.0)] * 2000 + [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.normal(size=2000).round(2))]
    rows += [("hot", None), (None, 1.0), (None, 3.0)]
    return spark.createDataFrame(rows, "g string, v double")


def test_quantiles_match_numpy(skewed):
    wanted = {"q1": (0.25, "midpoint"), "med": (0.5, "linear"), "p95": (0.95, "linear")}
    mine = {r["g"]: r for r in scale.group_quantiles(skewed, ["g"], "v", wanted).collect()}
    pdf = skewed.toPandas().dropna(subset=["v"])
    groups = pdf.assign(g=pdf["g"].fillna("none")).groupby("g")["v"]
    assert len(mine) == len(groups)
    for name, values in groups:
        row = mine[None if name == "none" else name]
        assert row["q1"] == pytest.approx(np.percentile(values, 25, method="midpoint"))
        assert row["med"] == pytest.approx(np.percentile(values, 50))
        assert row["p95"] == pytest.approx(np.percentile(values, 95))


def test_ranked_counts_without_groups(skewed):
    ranked = scale.ranked_counts(skewed, [], "v")
    total = skewed.where("v is not null").count()
    rows = ranked.orderBy("v").collect()
    assert sum(r["n"] for r in rows) == total == rows[0]["total"]
    below = 0
    for r in rows:
        assert r["below"] == below
        below += r["n"]


def test_chunk_of_is_a_search(spark):
    cuts = [1.0, 2.0, 2.5, 9.0]
    df = spark.createDataFrame([(x,) for x in (-5.0, 1.0, 1.5, 2.0, 2.4, 2.5, 8.0, 9.0, 10.0)], "v double")
    got = [r[0] for r in df.select(scale.chunk_of(F.col("v"), cuts)).collect()]
    assert got == [int(np.searchsorted(cuts, x, side="right")) for x in (-5.0, 1.0, 1.5, 2.0, 2.4, 2.5, 8.0, 9.0, 10.0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_by_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    text = plan(changes.latest_by_key(df, ["k"], [F.desc("t")]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_event_paths_limit_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS u", "string(id % 5) AS e", "id AS t")
    assert "WindowGroupLimit" in plan(series.event_paths(df, "u", "e", ["t"], 3))


def test_no_cartesian_products(spark):
    import __spark_entry__ as entry_module

    for name in ("densify_events", "resample_6h_linear", "share_of_column", "heatmap_norm", "nation_flow_matrix", "ip_ranges_join"):
        text = plan(entry_module.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_many_pivot_labels(spark):
    rows = spark.range(1_500).selectExpr("id AS label")
    assert len(scale.pivot_values(rows, "label")) == 1_500


def test_numbered_is_one_total_order(spark):
    rows = [(i % 3 if i % 2 else 7, i) for i in range(2000)] + [(None, 2000), (None, 2001)]
    df = spark.createDataFrame(rows, "score int, id int").repartition(6)
    mine = [(r["score"], r["id"], r["place"]) for r in scale.numbered(df, [F.desc("score"), F.asc("id")], "place").collect()]
    best = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted(mine, key=lambda r: r[2]) == [(*r, i) for i, r in enumerate(best)]


def test_numbered_keeps_columns_and_empty_frames(spark):
    df = spark.createDataFrame([], "a int, b string")
    out = scale.numbered(df, ["a"], "n")
    assert out.columns == ["a", "b", "n"] and out.count() == 0
