"""Series operators against pandas on small frames, with tiny window pieces as well."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from millrace.errors import QueryError
from millrace.operators import series

DAY = datetime(2019, 1, 1)


def sparse_rows(n=40, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for name in ("a", "b", "c"):
        for i in range(n):
            if rng.random() < 0.7:
                value = None if rng.random() < 0.15 else float(np.round(rng.normal(10, 4), 3))
                rows.append((name, DAY + timedelta(days=i), value))
    return rows


ROWS = sparse_rows()


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, "s string, t timestamp_ntz, v double")


def wide():
    return pd.DataFrame(ROWS, columns=["s", "t", "v"]).pivot(index="t", columns="s", values="v").astype(float)


def to_wide(df, value):
    pdf = df.toPandas()
    return pdf.pivot(index="t", columns="s", values=value).astype(float).sort_index()


def same(mine, theirs):
    pd.testing.assert_frame_equal(mine, theirs.sort_index(), check_freq=False, check_names=False, atol=1e-7)


@pytest.fixture(params=[100_000, 8], ids=["one piece", "small pieces"])
def chunk(request, monkeypatch):
    monkeypatch.setattr(series, "CHUNK", request.param)


@pytest.mark.parametrize("kind", [k for k in series.ROLLING_KINDS if k not in ("corr", "cov", "quantile", "count")])
@pytest.mark.parametrize("min_periods", [None, 0, 3])
def test_rolling(frame, chunk, kind, min_periods):
    mine = series.rolling(frame, ["s"], "t", {"v": "r"}, kind, 6, min_periods)
    theirs = getattr(wide().rolling(6, min_periods=min_periods), kind)()
    if min_periods:
        theirs = theirs[min_periods:]
    if kind in ("skew", "kurt"):
        # a window of equal values has no shape; pandas answers 0 or -3 there
        theirs = theirs.where(wide().rolling(6, min_periods=1).std().loc[theirs.index] > 0)
        mine_wide = to_wide(mine, "r")
        same(mine_wide.where(theirs.notna()), theirs.where(mine_wide.notna()))
        return
    same(to_wide(mine, "r"), theirs)


def test_rolling_centered(frame, chunk):
    for window in (4, 5):
        mine = series.rolling(frame, ["s"], "t", {"v": "r"}, "sum", window, 1, center=True, drop_warmup=False)
        same(to_wide(mine, "r"), wide().rolling(window, min_periods=1, center=True).sum())


def test_rolling_quantile(frame, chunk):
    mine = series.rolling(frame, ["s"], "t", {"v": "r"}, "quantile", 5, 1, quantile=0.3, drop_warmup=False)
    same(to_wide(mine, "r"), wide().rolling(5, min_periods=1).quantile(0.3))


@pytest.mark.parametrize("op", ["sum", "prod", "min", "max"])
def test_cumulative(frame, chunk, op):
    mine = to_wide(series.cumulative(frame, ["s"], "t", {"v": "c"}, op), "c")
    theirs = getattr(wide(), f"cum{op}")()
    pd.testing.assert_frame_equal(mine, theirs, check_freq=False, check_names=False, rtol=1e-9)


@pytest.mark.parametrize("periods", [1, 3, -2])
def test_diff(frame, chunk, periods):
    same(to_wide(series.diff(frame, ["s"], "t", {"v": "d"}, periods), "d"), wide().diff(periods))


HOURS = [(n, DAY + timedelta(hours=int(h)), float(v)) for n, step in (("a", 7), ("b", 11)) for h, v in zip(range(3, 200, step), range(1, 60))]


@pytest.mark.parametrize(
    "method, rule, grain, how",
    [
        ("asfreq", "6h", "PT6H", lambda r: r.asfreq()),
        ("ffill", "6h", "PT6H", lambda r: r.ffill()),
        ("bfill", "6h", "PT6H", lambda r: r.bfill()),
        ("linear", "6h", "PT6H", lambda r: r.interpolate()),
        ("mean", "1D", "P1D", lambda r: r.mean()),
        ("median", "1D", "P1D", lambda r: r.median()),
        ("sum", "1D", "P1D", lambda r: r.sum()),
    ],
)
def test_resample(spark, chunk, method, rule, grain, how):
    df = spark.createDataFrame(HOURS, "s string, t timestamp_ntz, v double")
    frame = pd.DataFrame(HOURS, columns=["s", "t", "v"]).pivot(index="t", columns="s", values="v")
    same(to_wide(series.resample(df, ["s"], "t", ["v"], grain, method), "v"), how(frame.resample(rule)))


def test_resample_fill_value(spark):
    df = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + timedelta(days=3), 2.0)], "s string, t timestamp_ntz, v double")
    rows = sorted(tuple(r) for r in series.resample(df, ["s"], "t", ["v"], "P1D", "asfreq", 0.0).select("t", "v").collect())
    assert [v for _, v in rows] == [1.0, 0.0, 0.0, 2.0]


def test_align_matches_time_interpolation(spark, chunk):
    left = [(DAY + timedelta(hours=h), float(h)) for h in range(0, 48, 5)]
    right = [(DAY + timedelta(hours=h), float(h * h)) for h in range(1, 40, 7)]
    a = spark.createDataFrame(left, "t timestamp_ntz, v double")
    b = spark.createDataFrame(right, "t timestamp_ntz, v double")
    mine = series.align_series(a, b, "t", "v").toPandas().set_index("t").sort_index()["v__other"].astype(float)
    sa, sb = pd.Series(dict(left)), pd.Series(dict(right))
    both = sb.reindex(sa.index.union(sb.index)).interpolate(method="time").reindex(sa.index)
    pd.testing.assert_series_equal(mine, both, check_names=False, check_freq=False)


def test_forecast_recovers_a_line(spark):
    rows = [("x", DAY + timedelta(days=i), 5.0 + 2.0 * i) for i in range(20)]
    out = series.forecast(spark.createDataFrame(rows, "s string, t timestamp_ntz, v double"), ["s"], "t", "v", 3, "P1D", 0.9)
    future = sorted((r["t"], r["__yhat"], r["__yhat_lower"], r["__yhat_upper"]) for r in out.where("v is null").collect())
    assert [f[0] for f in future] == [DAY + timedelta(days=20 + k) for k in range(3)]
    for k, (_, mid, low, high) in enumerate(future):
        assert mid == pytest.approx(5.0 + 2.0 * (20 + k))
        assert low <= mid + 1e-9 and mid <= high + 1e-9


def test_forecast_validates(spark):
    df = spark.createDataFrame([("x", DAY, 1.0)], "s string, t timestamp_ntz, v double")
    for bad in ({"periods": -1}, {"interval": 1.0}, {"interval": 0.0}, {"grain": "PT6H"}):
        options = {"periods": 1, "grain": "P1D", "interval": 0.8, **bad}
        with pytest.raises(QueryError):
            series.forecast(df, ["s"], "t", "v", **options)


def test_bad_requests(frame):
    with pytest.raises(QueryError):
        series.rolling(frame, ["s"], "t", {"v": "r"}, "mean", 0)
    with pytest.raises(QueryError):
        series.rolling(frame, ["s"], "t", {"v": "r"}, "nope", 2)
    with pytest.raises(QueryError):
        series.cumulative(frame, ["s"], "t", {"v": "r"}, "mean")
    with pytest.raises(QueryError):
        series.resample(frame, ["s"], "t", ["v"], "P1D", "nearest")
    with pytest.raises(QueryError):
        series.compare(frame, ["v"], [], "ratio")


def test_compare_zero_and_half_even(spark):
    df = spark.createDataFrame([(2.0, 0.0), (1.00005, 1.0), (None, 1.0)], "a double, b double")
    out = [r[0] for r in series.compare(df, ["a"], ["b"], "ratio", drop=True).collect()]
    assert out[0] is None and out[1] in (1.0, 1.0001) and out[2] is None


def test_period_overlay_names(spark):
    rows = [(DAY + timedelta(days=i), float(i)) for i in range(21)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v double")
    out = series.period_overlay(df, "t", "v", "week")
    assert {r["series"] for r in out.collect()} == {"current", "-1", "-2", "-3"}


def test_trend_headline_skips_null_newest(spark):
    rows = [(DAY + timedelta(days=i), v) for i, v in enumerate([2.0, 4.0, None])]
    out = series.trend_headline(spark.createDataFrame(rows, "t timestamp_ntz, v double"), "t", "v", 2).first()
    assert (out["headline"], out["headline_time"], out["change"]) == (4.0, DAY + timedelta(days=1), 1.0)


def test_event_paths(spark):
    rows = [("u", "a", 1), ("u", "b", 2), ("u", "c", 3), ("w", "a", 1), ("w", "b", 5)]
    out = series.event_paths(spark.createDataFrame(rows, "e string, k string, o int"), "e", "k", ["o"], 2)
    assert {(r["path"], r["entities"]) for r in out.collect()} == {("a", 2), ("a > b", 2)}


def test_fill_neighbor(spark):
    rows = [("s", DAY + timedelta(days=i), v) for i, v in enumerate([None, None, 1.0, None, None])]
    out = series.fill_neighbor(spark.createDataFrame(rows, "s string, t timestamp_ntz, v double"), ["s"], "t", "v", 0.0)
    assert [r["v"] for r in out.orderBy("t").collect()] == [None, 0.0, 1.0, 0.0, None]


def test_own_rows_without_the_grid(frame, chunk):
    mine = series.rolling(frame, ["s"], "t", {"v": "r"}, "mean", 4, 1, dense=False, drop_warmup=False).toPandas()
    pdf = pd.DataFrame(ROWS, columns=["s", "t", "v"]).sort_values(["s", "t"])
    pdf["r"] = pdf.groupby("s")["v"].transform(lambda v: v.astype(float).rolling(4, min_periods=1).mean())
    mine = mine.sort_values(["s", "t"]).reset_index(drop=True)
    pd.testing.assert_series_equal(mine["r"].astype(float), pdf["r"].reset_index(drop=True), atol=1e-9)
