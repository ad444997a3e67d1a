"""Specs, filters, grains, projections and ordering on literal frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.functions import grains, text
from millrace.operators import filters, ordering, project
from millrace.operators.aggregates import aggregate, contribution, scalar_alert
from millrace.operators.filters import Filter, request_values
from millrace.operators.joins import dedup_names
from millrace.operators.query import Dataset, Metric, QuerySpec, run_query, time_offset_join


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (datetime(2019, 1, 31), "UK", 5.0), (datetime(2019, 2, 28), None, 8.0), (datetime(2020, 1, 31), "UK", 10.0),
        (datetime(2020, 2, 29), "US", 6.0), (datetime(2020, 2, 29), None, 9.0),
    ]
    return spark.createDataFrame(rows, "t timestamp_ntz, c string, v double")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_empty_query_is_refused(sales):
    with pytest.raises(QueryError):
        run_query(QuerySpec(Dataset(sales)))
    with pytest.raises(QueryError):
        run_query(QuerySpec(Dataset(sales), columns=["c"], metrics=["nothing"]))
    with pytest.raises(QueryError):
        run_query(QuerySpec(Dataset(sales), columns=["c"], is_timeseries=True))
    with pytest.raises(QueryError):
        run_query(QuerySpec(Dataset(sales), columns=["c"], metrics=[], row_offset=3))
    with pytest.raises(QueryError):
        run_query(QuerySpec(Dataset(sales), columns=["c"], post_processing=[("unknown", {})]))


def test_null_series_survive_the_series_limit(sales):
    spec = dict(columns=["c"], metrics=[Metric("v", "v", "SUM")], series_columns=["c"], series_limit=2)
    assert rows(run_query(QuerySpec(Dataset(sales), **spec))) == [("UK", 15.0), (None, 17.0)]
    assert rows(run_query(QuerySpec(Dataset(sales), **spec, null_safe_series=False))) == [("UK", 15.0)]


def test_time_offset_clamps_month_ends(sales):
    spec = QuerySpec(
        Dataset(sales, time_col="t"), columns=["c"], metrics=[Metric("v", "v", "SUM")], is_timeseries=True,
        since=datetime(2020, 1, 1), until=datetime(2021, 1, 1),
    )
    out = {(r["__timestamp"].month, r["c"]): r["v__1 year ago"] for r in time_offset_join(spec, ["1 year ago"]).collect()}
    assert out == {(1, "UK"): 5.0, (2, "US"): None, (2, None): None}
    with pytest.raises(QueryError):
        time_offset_join(QuerySpec(Dataset(sales, time_col="t"), columns=["c"], metrics=[], is_timeseries=True), ["1 year ago"])


def test_filter_errors(sales):
    for bad in (Filter("v", ">", None), Filter("v", "IN", []), Filter("v", "NEAR", 3), Filter("v", ">", "text")):
        with pytest.raises(QueryError):
            filters.apply_filters(sales, [bad])
    with pytest.raises(QueryError):
        filters.free_clause(sales, "v > (select max(v) from x)")


def test_null_in_lists(sales):
    assert filters.apply_filters(sales, [Filter("c", "IN", ["US", None])]).count() == 3
    assert filters.apply_filters(sales, [Filter("c", "NOT IN", ["US", None])]).count() == 2
    assert filters.apply_filters(sales, [Filter("c", "NOT IN", ["US"])]).count() == 2


def test_request_values():
    assert request_values(["17", "-3", "2.5\n", "1e3", 4, None, "many", ""], "NUMERIC") == [17, -3, 2.5, 1000, 4, None, None, None]
    assert request_values(["<empty string>", "<NULL>", "\tx", None], "STRING") == ["", None, "x", None]
    assert request_values(["True ", "yes", 2, 0, 0.0, True, None, "<NULL>"], "BOOLEAN") == [True, False, True, False, False, True, None, None]
    assert request_values([86_400_000, 1.5, "2020-01-01"], "TEMPORAL") == [datetime(1970, 1, 2), datetime(1970, 1, 1, 0, 0, 0, 1500), "2020-01-01"]
    assert request_values([], "NUMERIC") == []


def test_addresses_and_ports(spark):
    ips = spark.createDataFrame([(1,), (16843009,), (16843010,), (4294967295,)], "ip long")
    assert rows(filters.filter_ip(ips, "ip", "==", ["1.1.1.1"])) == [(16843009,)]
    assert rows(filters.filter_ip(ips, "ip", "NOT IN", ["1.1.1.0/24"])) == [(1,), (4294967295,)]
    assert filters.filter_ip(ips, "ip", ">", ["1.1.1.0/24"]).count() == 1
    for bad in ("300.1.1.1", "word"):
        with pytest.raises(QueryError):
            filters.filter_ip(ips, "ip", "==", [bad])
    ports = spark.createDataFrame([(20,), (21,), (80,)], "p int")
    assert rows(filters.filter_port(ports, "p", "==", ["ftp"])) == [(20,), (21,)]
    assert rows(filters.filter_port(ports, "p", ">", ["ftp"])) == [(21,), (80,)]
    for bad in ("0", 70000, "gopher"):
        with pytest.raises(QueryError):
            filters.filter_port(ports, "p", "==", [bad])


def test_latest_partition_refuses_loose_keys(sales):
    with pytest.raises(QueryError):
        filters.latest_partition(sales, ["t", "c", "v"], c="UK")
    with pytest.raises(QueryError):
        filters.latest_partition(sales, ["t"], other=1)


def test_unknown_grain(sales):
    with pytest.raises(QueryError):
        sales.select(grains.time_bucket("t", "PT7M"))


def test_projection_steps(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project.select_op(df, ["a", "b"], ["b"], {"a": "z"}).columns == ["z"]
    with pytest.raises(QueryError):
        project.select_op(df, ["a", "missing"])
    with pytest.raises(QueryError):
        project.rename_op(df, {"a": "b"})
    wide = spark.createDataFrame([(1, 2)], "`count, UK` int, `count, US` int")
    assert project.rename_op(wide, {"count": None}, level=0).columns == ["UK", "US"]
    assert project.rename_op(wide, {"count": "n"}, level=0).columns == ["n, UK", "n, US"]


def test_expand_nested_breadth_first(spark):
    df = spark.sql("SELECT 1 AS id, array(struct(1 AS x, array(7, 8) AS ys), struct(2 AS x, array(9) AS ys)) AS items, array('p') AS tags")
    out = project.expand_nested(df)
    assert out.columns == ["id", "items.x", "items.ys", "tags"]
    assert rows(out) == sorted([(1, 1, 7, "p"), (None, None, 8, None), (None, 2, 9, None)], key=str)
    empty = spark.sql("SELECT 1 AS id, cast(array() AS array<int>) AS xs")
    assert rows(project.expand_nested(empty)) == [(1, None)]


def test_text_rules(spark):
    cells = ["=1", "@x", "-5.5", "-a", "  +b", 'a"', '""=c', '"=d', "ok", "|cmd|", "%"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(text.guard_cell("c")).collect()]
    assert got == ["'=1", "'@x", "-5.5", "'-a", "'  +b", 'a"', "'\"\"=c", '"=d', "ok", "'\\|cmd\\|", "'%"]
    names = spark.createDataFrame([("a10",), ("a9",), ("a009",), ("b1x20",), ("b1x3",)], "c string")
    assert [r[0] for r in names.orderBy(text.natural_key("c"), "c").collect()] == ["a009", "a9", "a10", "b1x3", "b1x20"]
    assert text.join_label(["m", None, "a,b"]) == "m, a\\,b" and text.unescape_label("a\\,b") == "a,b"


def test_limits(spark):
    assert ordering.effective_limit(None) == 50_000
    assert ordering.effective_limit(0) == 100_000
    assert ordering.effective_limit(500_000) == 100_000
    df, more = ordering.limit_with_flag(spark.range(5), 5)
    assert not more and df.count() == 5
    with pytest.raises(QueryError):
        ordering.page(spark.range(5), [], 2)
    assert rows(ordering.page(spark.range(7), ["id"], 3, 3)) == [(6,)]


def test_aggregate_names_and_errors(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 2), ("b", None, 3)], "g string, v double, o int")
    out = aggregate(df, [], {"m": {"column": "v", "operator": "mean"}, "s": ("v", "sum"), "am": ("v", "argmax")}, order="o")
    assert rows(out) == [(2.0, 4.0, 1)]
    assert rows(aggregate(df, ["g"], {"s": ("v", "sum"), "p": ("v", "nanmedian")})) == [("a", 4.0, 2.0), ("b", 0.0, None)]
    for bad in ({"x": ("v", "nope")}, {"x": ("w", "sum")}, {"x": ("v", "argmin")}, {"x": ("v", "cumsum")}, {}):
        with pytest.raises(QueryError):
            aggregate(df, ["g"], bad)


def test_contribution_sums_to_one(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 3.0, 2.0), ("c", None, 6.0)], "k string, x double, y double")
    shares = contribution(df).collect()
    assert sum(r["x"] for r in shares) == pytest.approx(1) and sum(r["y"] for r in shares) == pytest.approx(1)
    by_row = contribution(df, "row", ["x", "y"], ["p", "q"]).collect()
    assert all(r["p"] + r["q"] == pytest.approx(1) for r in by_row)
    with pytest.raises(QueryError):
        contribution(df, "column", ["k"])


def test_scalar_alert(spark):
    one = spark.sql("SELECT cast(NULL AS double) AS v")
    assert scalar_alert(one, "not null").first()["fires"] is False
    assert scalar_alert(spark.sql("SELECT 5 AS v"), ">", 4).first()["fires"] is True
    with pytest.raises(QueryError):
        scalar_alert(spark.range(2), ">", 0)
    with pytest.raises(QueryError):
        scalar_alert(spark.sql("SELECT 1 AS a, 2 AS b"), ">", 0)


def test_name_suffixes():
    assert dedup_names(["foo", "bar", "bar", "bar"]) == ["foo", "bar", "bar__1", "bar__2"]


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    kept = filters.apply_filters(orders, [Filter("o_orderdate", "TEMPORAL_RANGE", (datetime(1998, 1, 1), None))])
    plan = kept.select("o_orderkey").where(F.col("o_orderkey") > 5)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_dataset_time_formats_and_offset(spark):
    df = spark.createDataFrame([(3600, 1.0), (7200, 2.0)], "at long, v double")
    dataset = Dataset(df, time_col="at", time_formats={"at": "epoch_s"}, offset_hours=2)
    spec = QuerySpec(dataset, metrics=[Metric("v", "v", "SUM")], is_timeseries=True, grain="PT1H", since=datetime(1970, 1, 1, 2))
    assert rows(run_query(spec)) == [(datetime(1970, 1, 1, 4), 2.0)]


def test_published_datasets_and_parameters(spark, sales):
    from millrace.operators.filters import RowRule
    from millrace.operators.query import publish, run_sql

    publish(Dataset(sales, rules=[RowRule("v > 5", frozenset({"clerk"}))]), "sales_view", role="clerk")
    df, more = run_sql(spark, "SELECT c, v FROM sales_view WHERE v < :top", {"top": 9.5}, limit=1)
    assert more and df.count() == 1
    assert run_sql(spark, "SELECT count(*) AS n FROM sales_view")[0].first()["n"] == 4


def test_positions_of_repeated_extremes(spark):
    rows_ = [("a", 2.0, 10), ("a", 1.0, 20), ("a", 1.0, 30), ("a", 2.0, 40), ("b", None, 50)]
    df = spark.createDataFrame(rows_, "g string, v double, o int")
    out = aggregate(df, ["g"], {"lo": ("v", "argmin"), "hi": ("v", "argmax")}, order="o")
    assert rows(out) == [("a", 1, 0), ("b", None, None)]


@pytest.mark.parametrize(
    "clause",
    ["id in (select\tid from secret)", "id in (select/**/id from secret)", "exists (select 1)", "id = (\nselect max(id) from secret)", "id > 0 and (id, id) in (select id, id from secret)"],
)
def test_free_clause_refuses_every_sub_query(spark, clause):
    spark.range(3).createOrReplaceTempView("secret")
    with pytest.raises(QueryError):
        filters.free_clause(spark.range(5), clause)


def test_free_clause_takes_the_word_as_text(spark):
    df = spark.createDataFrame([("select me",), ("other",)], "s string")
    assert filters.free_clause(df, "s = 'select me'").count() == 1


def test_natural_order_of_long_digit_runs(spark):
    names = spark.createDataFrame([("a1234567890123",), ("a2",), ("a10",), ("a0002b",), ("a",), (None,)], "c string")
    found = [r[0] for r in names.orderBy(text.natural_key("c").asc_nulls_last(), "c").collect()]
    assert found == ["a", "a2", "a0002b", "a10", "a1234567890123", None]


def test_distinct_values_returns_all_unless_told(spark):
    df = spark.range(20_000).selectExpr("string(id) AS v")
    assert ordering.distinct_values(df, "v").count() == 20_000
    assert ordering.distinct_values(df, "v", n=7).count() == 7


def test_names_are_unique():
    assert dedup_names(["a", "a", "a__1"]) == ["a", "a__2", "a__1"]
