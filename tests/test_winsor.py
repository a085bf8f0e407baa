import numpy as np
import pytest

from barloom.operators import winsor


def table(spark, sizes, seed=1):
    """``(key, period, n)``: x heavy-tailed, y skewed and often null."""
    rng = np.random.default_rng(seed)
    rows = []
    for key, period, n in sizes:
        x, y = rng.standard_t(3, n), rng.exponential(size=n)
        rows += [(key, period, float(a), None if rng.random() < 0.3 else float(b)) for a, b in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "symbol string, period string, x double, y double"), rows


def history(rows, key, period, column):
    return np.array([r[column] for r in rows if r[0] == key and r[1] < period and r[column] is not None and not np.isnan(r[column])])


SIZES = [("a", "2024-01", 3000), ("a", "2024-02", 500), ("a", "2024-04", 4000), ("b", "2024-02", 40), ("b", "2024-03", 60)]


def test_exact_bounds_of_all_columns_at_once(spark):
    df, rows = table(spark, SIZES)
    for r in winsor.accumulated_bounds(df, ["x", "y"], "period").collect():
        for column, lo, hi in ((2, r.lo_x, r.hi_x), (3, r.lo_y, r.hi_y)):
            values = history(rows, r.symbol, r.period, column)
            assert (lo, hi) == ((None, None) if not len(values) else pytest.approx(tuple(np.quantile(values, [0.01, 0.99]))))


@pytest.mark.parametrize("k", [200, 2000])
def test_sketched_bounds_are_within_the_stated_error(spark, k):
    df, rows = table(spark, SIZES)
    error = 2.296 / k**0.9433
    found = winsor.accumulated_bounds(df, ["x", "y"], "period", lower=0.05, upper=0.9, exact_rows=0, k=k).collect()
    assert len(found) == len(SIZES)
    for r in found:
        for column, lo, hi in ((2, r.lo_x, r.hi_x), (3, r.lo_y, r.hi_y)):
            values = history(rows, r.symbol, r.period, column)
            if not len(values):
                assert (lo, hi) == (None, None)
                continue
            for bound, p in ((lo, 0.05), (hi, 0.9)):
                assert bound in values and abs((values <= bound).mean() - p) <= error + 1 / len(values)


def test_small_and_large_keys_together(spark):
    df, _ = table(spark, SIZES)
    both = {(r.symbol, r.period): tuple(r)[2:] for r in winsor.accumulated_bounds(df, ["x"], "period", exact_rows=1000).collect()}
    exact = {(r.symbol, r.period): tuple(r)[2:] for r in winsor.accumulated_bounds(df, ["x"], "period").collect()}
    assert both.keys() == exact.keys() and both["b", "2024-03"] == exact["b", "2024-03"]
    assert both["a", "2024-04"] == pytest.approx(exact["a", "2024-04"], rel=0.02)


def test_later_periods_join_bounds_not_values(spark):
    df, _ = table(spark, SIZES[:2])
    plan = winsor.clip_accumulating(df, ["x", "y"], "period", exact_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("kll_sketch_agg_double") == 2 and plan.count("Join LeftOuter") == 1 and "Join Inner" not in plan


def test_edge_rows(spark):
    rows = [("a", 1, 1.0), ("a", 1, float("nan")), ("a", 1, None), ("a", 2, 100.0), ("a", 2, float("nan")), ("a", 2, None), (None, 2, 7.0), ("a", None, 8.0), ("c", 1, None), ("c", 2, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, period int, x double")
    for exact in (0, 100):
        out = winsor.clip_accumulating(df, ["x"], "period", exact_rows=exact)
        found = sorted((str(r.symbol), str(r.period), str(r.x)) for r in out.collect())
        assert found == sorted([("a", "1", "1.0"), ("a", "1", "nan"), ("a", "1", "None"), ("a", "2", "1.0"), ("a", "2", "1.0"), ("a", "2", "None"), ("None", "2", "7.0"), ("a", "None", "8.0"), ("c", "1", "None"), ("c", "2", "5.0")])
        assert winsor.clip_accumulating(df.limit(0), ["x"], "period", exact_rows=exact).collect() == []
