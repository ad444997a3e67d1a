"""Pivots, roll-ups, box plots, histograms, tests and quality on literal frames."""

from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.operators import aggregates, geo, graph, pivots, quality, stats


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        ("east", "hops", 40.0), ("east", "wheat", 30.0), ("west", "barley", 60.0), ("west", "corn", 70.0), ("west", "barley", None),
        ("west", None, 5.0),
    ]
    return spark.createDataFrame(rows, "site string, name string, num double")


def test_pivot_names_and_nulls(frame):
    wide = pivots.pivot(frame, ["site"], ["name"], {"num": ("num", "sum")})
    assert wide.columns == ["site", "num, <NULL>", "num, barley", "num, corn", "num, hops", "num, wheat"]
    out = {r["site"]: r.asDict() for r in wide.collect()}
    assert out["east"]["num, barley"] is None and out["west"]["num, barley"] == 60.0
    filled = pivots.pivot(frame, ["site"], ["name"], {"num": ("num", "sum")}, fill=0.0, column_fill=None)
    assert "num, <NULL>" not in filled.columns
    assert {r["site"]: r["num, barley"] for r in filled.collect()}["east"] == 0.0


def test_pivot_empty_columns(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None)], "i string, c string, v double")
    assert pivots.pivot(df, ["i"], ["c"], {"v": ("v", "mean")}).columns == ["i", "v, x"]
    assert pivots.pivot(df, ["i"], ["c"], {"v": ("v", "mean")}, drop_missing=False).columns == ["i", "v, x", "v, y"]
    for bad in (dict(index=[], aggs={"v": ("v", "sum")}), dict(index=["i"], aggs={})):
        with pytest.raises(QueryError):
            pivots.pivot(df, bad["index"], ["c"], bad["aggs"])


def test_pivot_label_may_equal_index_name(spark):
    df = spark.createDataFrame([("1", "P", 1.0)], "p string, c string, v double")
    assert pivots.pivot(df, ["p"], ["c"], {"v": ("v", "max")}).collect()[0].asDict() == {"p": "1", "v, P": 1.0}


def test_pivot_then_unpivot_is_identity(spark):
    rows = [("r1", "a", 1.0), ("r1", "b", 2.0), ("r2", "b", 3.0)]
    df = spark.createDataFrame(rows, "r string, c string, v double")
    wide = pivots.widen(df.withColumnRenamed("c", pivots.LABEL), ["r"], ["v"])
    long = wide.unpivot(["r"], [f"`{c}`" for c in wide.columns[1:]], "c", "v").dropna()
    assert sorted((r["r"], r["c"].removeprefix("v, "), r["v"]) for r in long.collect()) == rows


@pytest.mark.parametrize("row_totals", [False, True])
@pytest.mark.parametrize("col_totals", [False, True])
@pytest.mark.parametrize("combine", [False, True])
@pytest.mark.parametrize("transpose", [False, True])
def test_pivot_table_totals(frame, row_totals, col_totals, combine, transpose):
    wide = pivots.pivot_table(
        frame, ["site", "name"], [], ["num"], "Sum", transpose=transpose, combine=combine, row_totals=row_totals, col_totals=col_totals
    )
    rows = wide.collect()
    if transpose:
        assert wide.columns[0] == "metric" and len(rows) == 1
        assert len(wide.columns) == 1 + 5 + (3 if row_totals else 0)
        if row_totals:
            name = "Total (Sum), " if not combine else "Total (Sum), "
            total = [c for c in wide.columns if "Total (Sum)" in c]
            assert len(total) == 1 and rows[0][total[0]] == 205.0 and name in total[0] + ", "
    else:
        assert len(rows) == 5 + (3 if col_totals else 0)
        if col_totals:
            by_key = {(r["site"], r["name"]): r["num"] for r in rows}
            assert by_key[("Total (Sum)", "")] == 205.0
            assert by_key[("east", "Subtotal")] == 70.0 and by_key[("west", "NULL")] == 5.0


def test_pivot_table_single_metric(frame):
    out = pivots.pivot_table(frame, [], [], ["num"]).collect()
    assert len(out) == 1 and out[0]["metric"] == "Total (Sum)" and out[0]["num"] == 205.0


def test_pivot_fraction(frame):
    cells = pivots.pivot_cells(frame, ["site"], ["name"], "Sum as Fraction of Rows", "num")
    by_row = {}
    for r in cells.collect():
        by_row[r["site"]] = by_row.get(r["site"], 0) + (r["num"] or 0)
    assert by_row == {"east": pytest.approx(1), "west": pytest.approx(1)}
    with pytest.raises(QueryError):
        pivots.pivot_cells(frame, ["site"], [], "Mode", "num")


def test_variance_of_one_is_zero(spark):
    df = spark.createDataFrame([("a", 3.0)], "g string, v double")
    assert pivots.pivot_cells(df, ["g"], [], "Sample Variance", "v").first()["v"] == 0.0


def test_boxplot_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g in "ab" for v in np.round(rng.standard_t(2, 300), 2)] + [("a", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    mine = {r["g"]: r.asDict() for r in stats.boxplot(df, ["g"], ["v"]).collect()}
    lists = {}
    for r in stats.boxplot_outliers(df, ["g"], "v").collect():
        lists.setdefault(r["g"], []).extend([r["value"]] * r["n"])
    for g, values in pd.DataFrame(rows, columns=["g", "v"]).dropna().groupby("g")["v"]:
        q1, q3 = np.percentile(values, [25, 75], method="midpoint")
        top = values[values <= q3 + 1.5 * (q3 - q1)].max()
        bottom = values[values >= q1 - 1.5 * (q3 - q1)].min()
        out = sorted(values[(values > top) | (values < bottom)])
        m = mine[g]
        assert (m["v__q1"], m["v__q3"], m["v__max"], m["v__min"]) == pytest.approx((q1, q3, top, bottom))
        assert (m["v__mean"], m["v__median"]) == pytest.approx((values.mean(), values.median()))
        assert m["v__count"] == len(values) and m["v__outliers"] == len(out)
        assert sorted(lists.get(g, [])) == pytest.approx(out)
    for bad in ([90, 10], [10], None, ["a", "b"]):
        with pytest.raises(QueryError):
            stats.boxplot(df, ["g"], ["v"], "percentile", bad)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    out = [r["count"] for r in stats.histogram(df, "v", 5).orderBy("bin").collect()]
    assert out == [2, 2, 2, 2, 3]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["count"] for r in stats.histogram(flat, "v", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_break_points(spark):
    df = spark.createDataFrame([(0.0,), (100.0,)], "v double")
    assert stats.break_points(df, "v", 4) == [0.0, 25.0, 50.0, 75.0, 100.0]
    assert stats.break_points(df, "v", breaks=[5, 1]) == [1.0, 5.0]
    assert stats.break_points(df.limit(0), "v") == []


def test_heatmap_rank_matches_pandas(spark):
    rng = np.random.default_rng(2)
    rows = [(f"x{i % 4}", f"y{i // 4}", int(rng.integers(0, 6))) for i in range(40)]
    df = spark.createDataFrame(rows, "x string, y string, v int")
    pdf = pd.DataFrame(rows, columns=["x", "y", "v"])
    for across, ranks in (("heatmap", pdf.v.rank(pct=True)), ("x", pdf.groupby("x").v.rank(pct=True))):
        mine = {(r["x"], r["y"]): r["rank"] for r in stats.normalize_cells(df, "x", "y", "v", across).collect()}
        for (x, y, _), rank in zip(rows, ranks):
            assert mine[(x, y)] == pytest.approx(rank)


@pytest.mark.parametrize(
    "t, freedom, p",
    # textbook two-sided tail areas
    [(2.0, 10, 0.07338803), (1.0, 1, 0.5), (12.7062047, 1, 0.05), (2.0, 60, 0.05003304), (0.0, 5, 1.0), (4.0, 3, 0.02800778)],
)
def test_student_tail(spark, t, freedom, p):
    found = spark.range(1).select(stats.student_two_sided(F.lit(t), F.lit(int(freedom)))).first()[0]
    assert found == pytest.approx(p, abs=1e-6)


def test_paired_ttest(spark):
    rows = [(t, g, v) for g, values in (("c", [1.0, 2.0, 4.0, 4.0]), ("x", [2.0, 2.5, 5.0, 7.0])) for t, v in enumerate(values)]
    out = stats.paired_ttest(spark.createDataFrame(rows, "t int, g string, v double"), "t", "g", "v", "c").first()
    d = np.array([1.0, 0.5, 1.0, 3.0])
    t = -abs(d.mean() / (d.std(ddof=1) / 2))
    assert (out["n"], out["t"], out["lift"]) == (4, pytest.approx(t), pytest.approx(50.0))
    assert out["p"] == pytest.approx(spark.range(1).select(stats.student_two_sided(F.lit(t), F.lit(3))).first()[0])


def test_paired_ttest_skips_pairs_that_are_not_finite(spark):
    rows = [(0, "c", 1.0), (1, "c", 2.0), (2, "c", float("nan")), (3, "c", 5.0), (4, "c", float("inf"))]
    rows += [(0, "x", 2.0), (1, "x", 2.5), (2, "x", 5.0), (3, "x", 7.0), (4, "x", 1.0)]
    out = stats.paired_ttest(spark.createDataFrame(rows, "t int, g string, v double"), "t", "g", "v", "c").first()
    assert out["n"] == 3 and out["t"] is not None and 0 < out["p"] < 1
    alone = stats.paired_ttest(spark.createDataFrame(rows[:1] + rows[5:6], "t int, g string, v double"), "t", "g", "v", "c").first()
    assert (alone["n"], alone["t"], alone["p"]) == (1, None, None) or alone["p"] is None


def test_rollup_change_missing_side(spark):
    rows = [(1, "a", 2.0), (1, "b", 3.0), (2, "a", 5.0)]
    df = spark.createDataFrame(rows, "t int, g string, v double")
    out = {(r["level"], r["g"]): r["v"] for r in aggregates.rollup_change(df, ["g"], "t", ["v"], "point_percent").collect()}
    assert out == {(0, None): pytest.approx(0.0), (1, "a"): pytest.approx(1.5), (1, "b"): pytest.approx(-1.0)}


def test_chart_frame_defaults(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a", 1.0)], "g string, v double")
    assert aggregates.chart_frame(df, "sunburst", ["g"], [F.sum("v")]).columns == ["g", "m1", "m2"]
    with pytest.raises(QueryError):
        aggregates.chart_frame(df, "bubble", ["g"], [F.sum("v")])


# ---- geo -----------------------------------------------------------------------------------


def test_geohash_known_places(spark):
    rows = [("New York City", 40.71277496, -74.00597306), ("Sydney", -33.85598011, 151.20666526)]
    df = spark.createDataFrame(rows, "city string, lat double, lon double")
    coded = df.withColumn("g", geo.geohash_encode(df["lat"], df["lon"], 12))
    out = {r["city"]: r["g"] for r in coded.collect()}
    assert out["New York City"] == "dr5regw3pg6f" and out["Sydney"] == "r3gx2u9qdevk"
    for r in geo.from_geohash(coded, "g", 12).collect():
        assert r["latitude"] == pytest.approx(r["lat"], abs=1e-6) and r["longitude"] == pytest.approx(r["lon"], abs=1e-6)


def test_hexagons_hold_their_points(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b)) for a, b in rng.uniform(-50, 50, (200, 2))]
    df = spark.createDataFrame(rows, "lat double, lon double")
    assert sum(r["value"] for r in geo.hex_bin(df, "lat", "lon", 7.0, "count").collect()) == 200
    with pytest.raises(QueryError):
        geo.geo_grid(df, "lat", "lon", 1.0, "mode")


# ---- graph ---------------------------------------------------------------------------------


def test_sankey_refuses_loops(spark):
    good = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 2.0), ("b", "c", 1.0), ("a", None, 1.0)], "s string, t string, v double")
    assert {tuple(r) for r in graph.sankey_links(good, "s", "t", "v").collect()} == {("a", "b", 3.0), ("b", "c", 1.0)}
    bad = good.unionByName(spark.createDataFrame([("c", "b", 1.0)], "s string, t string, v double"))
    with pytest.raises(QueryError, match="b -> c"):
        graph.sankey_links(bad, "s", "t", "v")
    assert {tuple(r) for r in graph.cyclic_links(graph.sankey_links(bad, "s", "t", "v", True)).collect()} == {("b", "c"), ("c", "b")}


def test_node_totals_skip_empty_edges(spark):
    edges = spark.createDataFrame([("a", "b", 2.0), ("b", "a", 0.0), ("a", "c", None), ("a", "a", 1.0)], "s string, t string, v double")
    out = {r["node"]: r["value"] for r in graph.node_totals(edges, "s", "t", "v").collect()}
    assert out == {"a": 4.0, "b": 2.0}


def test_dense_matrix(spark):
    edges = spark.createDataFrame([("a", "b", 2.0), ("a", "b", 1.0)], "s string, t string, v double")
    out = {r["source"]: (r["a"], r["b"]) for r in graph.dense_matrix(edges, "s", "t", "v").collect()}
    assert out == {"a": (0.0, 3.0), "b": (0.0, 0.0)}


def test_hierarchy_picks_the_largest_only_child(spark):
    rows = [("r", None, 1.0), ("a", "r", 2.0), ("b", "r", 3.0), ("c", "a", 4.0)]
    out = {r["id"]: r for r in graph.hierarchy_rollup(spark.createDataFrame(rows, "id string, parent string, v double"), "id", "parent", "v").collect()}
    assert out["r"]["subtree"] == 10.0 and out["r"]["nodes"] == 4 and out["c"]["path"] == "r/a/c" and out["c"]["depth"] == 2
    given = graph.hierarchy_rollup(spark.createDataFrame(rows, "id string, parent string, v double"), "id", "parent", "v", root="a")
    assert {r["id"]: r["subtree"] for r in given.collect()} == {"a": 6.0, "c": 4.0}


# ---- quality -------------------------------------------------------------------------------


def test_quality(spark):
    df = spark.createDataFrame([(1, "1", 5.0), (2, "2", None), (3, "3", -1.0)], "id int, code string, v double")
    metrics = {(r["instance"], r["name"]): r["value"] for r in quality.quality_metrics(df, ["v"], ["v"]).collect()}
    assert metrics == {("*", "Size"): 3.0, ("v", "Completeness"): pytest.approx(2 / 3), ("v", "Mean"): 2.0}
    status = {r["check_name"]: r["status"] for r in quality.quality_checks(df, [("isComplete", "id"), ("isPositive", "v")]).collect()}
    assert status == {"isComplete(id)": "Success", "isPositive(v)": "Failure"}
    rules = {(r["column"], r["rule"]) for r in quality.suggest_constraints(df).collect()}
    assert ("code", "RetainType") in rules and ("id", "NonNegativeNumbers") in rules and ("v", "NonNegativeNumbers") not in rules
    assert ("v", "RetainCompleteness") in rules or ("v", "CompleteIfComplete") not in rules
    empty = quality.quality_metrics(df.limit(0), ["v"], ["v"]).collect()
    assert {r["name"]: r["value"] for r in empty} == {"Size": 0.0, "Completeness": None, "Mean": None}
    with pytest.raises(QueryError):
        quality.quality_checks(df, [("isNice", "v")])


def test_calendar_range(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31),), (datetime(2020, 3, 1),)], "t timestamp_ntz")
    assert aggregates.calendar_range(df, "t", "P1M").first()["cells"] == 3


def test_any_number_of_labels_as_rows(spark, monkeypatch):
    """100,000 labels: nothing is collected, totals included; as columns they are refused."""
    df = spark.range(200_000).selectExpr("id % 2 AS k", "id % 100000 AS label_id", "1.0D AS v")
    kept = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: pytest.fail("collected"))
    long = pivots.pivot_long(df, ["k"], ["label_id"], {"v": ("v", "sum")}, margins=True)
    table = pivots.pivot_table_long(df, ["k"], ["label_id"], ["v"], row_totals=True, col_totals=True)
    few = pivots.pivot(df, ["k"], ["label_id"], {"v": ("v", "sum")}, labels=["3", "4", "none"])
    monkeypatch.setattr(type(df), "collect", kept)
    assert long.count() == table.count() == 100_000 * 2 + 3
    assert {tuple(r) for r in few.collect()} == {(1, 2.0, None, None), (0, None, 2.0, None)}
    assert few.columns == ["k", "v, 3", "v, 4", "v, none"]
    with pytest.raises(QueryError, match="long form"):
        pivots.pivot(df, ["k"], ["label_id"], {"v": ("v", "sum")})
