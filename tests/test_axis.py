"""Resample rules, distributed axes and weighted windows against pandas and numpy."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from millrace.errors import QueryError
from millrace.operators import axis, kernels, series

START = datetime(2020, 11, 18, 7, 30)
# irregular times of two series over two years, month and year ends among them
TIMES = [START + timedelta(hours=61 * i + (i * i) % 47) for i in range(260)] + [datetime(2020, 12, 31), datetime(2021, 2, 28, 23, 59), datetime(2022, 1, 31)]
ROWS = [("a" if i % 3 else "b", t, float(i % 17) if i % 11 else None) for i, t in enumerate(TIMES)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, "s string, t timestamp_ntz, v double").repartition(3)


def wide():
    return pd.DataFrame(ROWS, columns=["s", "t", "v"]).pivot(index="t", columns="s", values="v").astype(float)


def to_wide(df):
    return df.toPandas().pivot(index="t", columns="s", values="v").astype(float).sort_index()


@pytest.mark.parametrize("rule, alias, method", [
    ("7D", "7D", "sum"), ("36H", "36h", "mean"), ("90T", "90min", "sum"), ("1M", "ME", "median"), ("2M", "2ME", "sum"), ("3MS", "3MS", "mean"),
    ("Q", "QE", "sum"), ("2QS", "2QS", "sum"), ("1A", "YE", "mean"), ("AS", "YS", "sum"), ("W", "W", "sum"), ("2W-WED", "2W-WED", "mean"), ("1M", "ME", "ffill"), ("MS", "MS", "bfill"),
])
def test_rules_match_pandas(frame, rule, alias, method):
    mine = to_wide(series.resample(frame, ["s"], "t", ["v"], rule, method))
    theirs = getattr(wide().resample(alias), method)()
    pd.testing.assert_frame_equal(mine, theirs, check_freq=False, check_names=False, atol=1e-9)


def test_unknown_rules():
    for rule in ("", "0D", "7X", "D7", "W-XYZ", "1M-SUN"):
        with pytest.raises(QueryError):
            axis.rule_of(rule)


def test_nothing_to_resample(frame):
    for method in ("sum", "median", "asfreq", "ffill", "linear"):
        assert series.resample(frame.limit(0), ["s"], "t", ["v"], "1M", method).count() == 0


def test_axis_in_small_steps(frame, monkeypatch):
    monkeypatch.setattr(axis, "STEP", 7)
    mine = to_wide(series.densify(frame, ["s"], "t"))
    pd.testing.assert_frame_equal(mine, wide(), check_freq=False, check_names=False)


def test_no_axis_is_one_array(spark, frame):
    text = series.densify(frame, ["s"], "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in text


@pytest.mark.parametrize("name, theirs", [("hamming", np.hamming), ("hann", np.hanning), ("bartlett", np.bartlett), ("blackman", np.blackman)])
@pytest.mark.parametrize("size", [1, 2, 7, 10])
def test_kernels_match_numpy(name, theirs, size):
    assert kernels.kernel(name, size) == pytest.approx(list(theirs(size)), abs=1e-12)


def test_kernels_by_hand():
    assert kernels.kernel("kaiser", 9, beta=6.5) == pytest.approx(list(np.kaiser(9, 6.5)), rel=1e-12)
    assert kernels.kernel("triang", 4) == pytest.approx([0.25, 0.75, 0.75, 0.25])
    assert kernels.kernel("triang", 5) == pytest.approx([1 / 3, 2 / 3, 1, 2 / 3, 1 / 3])
    assert kernels.kernel("gaussian", 3, std=2)[0] == pytest.approx(np.exp(-0.125))
    for name in kernels.KERNELS:
        options = {"gaussian": {"std": 2}, "kaiser": {"beta": 3}, "general_gaussian": {"power": 1, "width": 2}}.get(name, {})
        weights = kernels.kernel(name, 11, **options)
        assert weights == pytest.approx(weights[::-1]) and max(weights) == pytest.approx(weights[5]) and weights[5] == pytest.approx(1, abs=1e-6)
    for bad in (("nope", {}), ("gaussian", {}), ("hann", {"std": 1}), ("gaussian", {"std": 0})):
        with pytest.raises(QueryError):
            kernels.kernel(bad[0], 5, **bad[1])


@pytest.mark.parametrize("chunk, center", [(100_000, False), (9, True)])
def test_weighted_windows(frame, monkeypatch, chunk, center):
    monkeypatch.setattr(series, "CHUNK", chunk)
    weights, table = np.array(kernels.kernel("gaussian", 5, std=1.2)), wide()
    ahead = 2 if center else 0
    for kind in ("mean", "sum", "var"):
        mine = to_wide(series.rolling(frame, ["s"], "t", {"v": "v"}, kind, 5, 2, center, drop_warmup=False, win_type="gaussian", win_options={"std": 1.2}))
        for s in ("a", "b"):
            values = table[s].to_numpy()
            for i in range(0, len(values), 7):
                cells = [(values[i + k - 4 + ahead], weights[k]) for k in range(5) if 0 <= i + k - 4 + ahead < len(values)]
                x, w = (np.array(c) for c in zip(*[c for c in cells if not np.isnan(c[0])])) if any(not np.isnan(c[0]) for c in cells) else ([], [])
                got = mine[s].iloc[i]
                if len(x) < 2:
                    assert np.isnan(got)
                    continue
                mean = (w * x).sum() / w.sum()
                want = {"mean": mean, "sum": (w * x).sum(), "var": (w * (x - mean) ** 2).sum() * len(x) / ((len(x) - 1) * w.sum())}[kind]
                assert got == pytest.approx(want)
    with pytest.raises(QueryError):
        series.rolling(frame, ["s"], "t", {"v": "v"}, "median", 5, win_type="hann")


def test_own_rows_of_two_series(frame):
    out = series.cumulative(frame, ["s"], "t", {"v": "c"}, "sum", dense=False).toPandas().sort_values(["s", "t"])
    pdf = pd.DataFrame(ROWS, columns=["s", "t", "v"]).sort_values(["s", "t"])
    assert out["c"].astype(float).tolist() == pytest.approx(pdf.groupby("s")["v"].cumsum().astype(float).tolist(), nan_ok=True)
