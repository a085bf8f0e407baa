import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import stats


def test_shapiro_wilk_published_values():
    weights = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0])  # Shapiro and Wilk (1965)
    w, p = stats.shapiro_wilk(weights)
    assert w == pytest.approx(0.7888, abs=1e-4) and p == pytest.approx(0.0067, abs=1e-4)
    w, p = stats.shapiro_wilk(np.array([1.0, 2.0, 4.0]))
    assert w == pytest.approx(0.9643, abs=1e-4) and p == pytest.approx(0.6369, abs=1e-3)


def test_shapiro_wilk_edges():
    for x in ([], [1.0], [1.0, 2.0], [3.0] * 9, list(range(5000))):
        assert all(math.isnan(v) for v in stats.shapiro_wilk(np.array(x, dtype=float)))
    rng = np.random.default_rng(1)
    assert all(0 <= stats.shapiro_wilk(rng.normal(size=n))[1] <= 1 for n in (3, 4, 5, 6, 11, 12, 13, 50, 4999))
    assert stats.shapiro_wilk(rng.exponential(size=400))[1] < 1e-6
    share = np.mean([stats.shapiro_wilk(rng.normal(size=40))[1] < 0.05 for _ in range(600)])
    assert 0.02 < share < 0.09


def test_shapiro_by_key_leaves_large_groups_out(spark, monkeypatch):
    monkeypatch.setattr(stats, "SHAPIRO_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [("a", float(v)) for v in rng.normal(size=49)] + [("b", float(v)) for v in rng.normal(size=50)] + [("c", 1.0), ("c", None), ("d", float("nan"))]
    found = {r.k: r for r in stats.shapiro(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    want = stats.shapiro_wilk(np.array([v for k, v in rows if k == "a"]))
    assert (found["a"].shapiro_w, found["a"].shapiro_p) == pytest.approx(want)
    assert [(found[k].n, found[k].shapiro_w) for k in "bc"] == [(50, None), (1, None)] and "d" not in found


def test_adf_p_values_at_the_critical_values():
    """The two tables agree: 1 % and 5 % for long samples."""
    assert stats.adf_p_value(stats.ADF_1PCT[0]) == pytest.approx(0.01, abs=2e-4)
    assert stats.adf_p_value(stats.ADF_5PCT[0]) == pytest.approx(0.05, abs=2e-4)
    assert (stats.adf_p_value(-30.0), stats.adf_p_value(3.0)) == (0.0, 1.0) and math.isnan(stats.adf_p_value(float("nan")))
    at = np.linspace(-18, 2.7, 300)
    p = [stats.adf_p_value(v) for v in at]
    assert p == sorted(p)


def test_one_decomposition_finds_the_lag_that_separate_regressions_find():
    rng = np.random.default_rng(4)
    for n in (20, 60, 300):
        x = np.zeros(n)
        for i in range(3, n):
            x[i] = 0.4 * x[i - 1] - 0.3 * x[i - 3] + rng.normal()
        most = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))
        d = np.diff(x)
        y, aic = d[most:], []
        for lags in range(most + 1):
            design = np.column_stack([x[most:-1], *[d[most - k : len(d) - k] for k in range(1, lags + 1)], np.ones(len(y))])
            left = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
            aic.append(len(y) * math.log(left @ left / len(y)) + 2 * design.shape[1])
        stat, lag = stats.adf_best_lag(x)
        assert lag == int(np.argmin(aic))
        assert stat == pytest.approx(stats.adf_statistic(x, lag)[0], nan_ok=True)
    assert math.isnan(stats.adf_best_lag(np.arange(3.0))[0])


def test_upper_tail_of_f_as_a_column(spark):
    rows = [(f, d1, d2) for f in (1e-6, 0.3, 1.0, 2.5, 40.0) for d1, d2 in ((1, 1), (9, 21), (9, 690), (3, 50_000))]
    rows += [(0.0, 9, 20), (-1.0, 9, 20), (None, 9, 20), (1.0, 0, 20)]
    df = spark.createDataFrame(rows, "f double, d1 int, d2 int")
    for r in df.withColumn("p", stats.f_survival_column(F.col("f"), F.col("d1"), F.col("d2"))).collect():
        if r.f is None or r.d1 < 1:
            assert r.p is None
        else:
            assert r.p == pytest.approx(stats.f_survival(r.f, r.d1, r.d2), rel=1e-7, abs=1e-12)


def test_all_statistics_of_short_and_long_series(spark):
    rng = np.random.default_rng(6)
    rows = []
    for key, n in (("long", 200), ("short", 12), ("one", 1)):
        close = 100 * np.exp(np.cumsum(rng.normal(size=n)) / 50)
        rows += [(key, i, float(c), int(t), 1.0, float(c)) for i, (c, t) in enumerate(zip(close, rng.integers(5, 50, n), strict=True))]
    df = spark.createDataFrame(rows, "k string, at int, close double, n_ticks int, volume double, dollar double")
    found = {r.k: r for r in stats.all_statistics(df, ["k"], ["at"]).collect()}
    close = np.array([r[2] for r in rows if r[0] == "long"])
    ticks = np.array([r[3] for r in rows if r[0] == "long"], dtype=float)
    returns = np.diff(np.log(close))
    r = found["long"]
    assert (r.n_bars, found["short"].n_bars, found["one"].n_bars) == (200, 12, 1)
    assert (r.shapiro_w, r.shapiro_p) == pytest.approx(stats.shapiro_wilk(returns))
    stat, lag = stats.adf_best_lag(returns)
    assert (r.adf, r.lag, r.adf_p) == (pytest.approx(stat), lag, pytest.approx(stats.adf_p_value(stat)))
    assert r.acf_lag1 == pytest.approx(np.corrcoef(returns[1:], returns[:-1])[0, 1]) and r.abs_acf_lag1 == abs(r.acf_lag1)
    bins = returns[: len(returns) // 10 * 10].reshape(10, -1)
    assert r.variance_over_bins == pytest.approx(returns.var(ddof=1) / bins.var(axis=1, ddof=1).mean())
    assert r.quality_score == pytest.approx(stats.legacy_quality_score(returns, ticks))
    assert found["one"].adf is None or math.isnan(found["one"].adf)
    assert found["one"].std_return is None and found["one"].cv_ticks == 0.0
