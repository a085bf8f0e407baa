import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import stats
from barloom.operators import bars, ticks, trials

START = datetime.datetime(2024, 3, 1)


def walk(spark, sizes, seed=3):
    """Ticks of ``(symbol, day, n)``: a price walk, null keys among them."""
    rng = np.random.default_rng(seed)
    rows = []
    for symbol, day, n in sizes:
        price = 100 + np.cumsum(rng.normal(size=n)).round(1)
        at = START + datetime.timedelta(days=day or 0)
        rows += [(symbol, None if day is None else at.date(), i, at + datetime.timedelta(seconds=i), float(abs(p) + 1), float(q)) for i, (p, q) in enumerate(zip(price, rng.integers(1, 9, n), strict=True))]
    df = spark.createDataFrame(rows, "symbol string, day date, id long, ts timestamp_ntz, price double, quantity double")
    return df.withColumn("dollar", F.col("price") * F.col("quantity"))


GRID = [(0, 0.9, 30.0), (1, 0.95, 12.0), (2, 0.99, 70.0), (3, 0.9, 5.0)]


def rows_of(df, columns):
    return sorted(tuple(r) for r in df.select(columns).collect())


def test_candidates_side_by_side_equal_folds_of_their_own(spark):
    df = walk(spark, [("a", 0, 2500), ("a", 1, 400), ("b", 0, 999), ("b", 1, 9), ("c", None, 50), (None, 0, 50)])
    directed = ticks.with_direction(df, ["symbol", "day"])
    columns = ["symbol", "day", "bar_id", "open_time", "close_time", "open", "close", "high", "low", "n_ticks", "volume"]
    both = bars.candidate_bars(df, ["symbol", "day"], GRID, 5)
    assert dict(both.dtypes)["open_time"] == "timestamp_ntz"
    for i, lam, t0 in GRID:
        alone = rows_of(bars.run_bars(directed, ["symbol", "day"], lam, t0, 5), columns)
        assert alone and alone == rows_of(both.where(F.col("param_id") == i), columns)
    assert {r.symbol for r in both.select("symbol").distinct().collect()} == {"a", "b"}  # a null key is no scope


def test_lists_by_scope(spark):
    df = walk(spark, [("a", 0, 1500), ("b", 0, 300), ("c", 0, 300)])
    lists = spark.createDataFrame([("a", START.date(), [GRID[0], GRID[3]]), ("b", START.date(), [GRID[1]]), ("z", START.date(), [GRID[1]]), ("c", START.date(), [])], f"symbol string, day date, candidates {bars.CANDIDATES}")
    found = bars.candidate_bars(df, ["symbol", "day"], lists, 5)
    everything = bars.candidate_bars(df, ["symbol", "day"], GRID, 5)
    want = everything.where("(symbol = 'a' and param_id in (0, 3)) or (symbol = 'b' and param_id = 1)")
    assert rows_of(found, found.columns) == rows_of(want, found.columns) != []
    scored = trials.score_candidates(df, ["symbol", "day"], lists, 5)
    assert rows_of(scored, ["symbol", "param_id"]) == [("a", 0), ("a", 3), ("b", 1)]
    counts = {(r.symbol, r.param_id): r["count"] for r in found.groupBy("symbol", "param_id").count().collect()}
    assert {(r.symbol, r.param_id): r.bars for r in scored.collect()} == counts


def test_ticks_are_shuffled_once_and_carry_no_candidates(spark):
    df = walk(spark, [("a", 0, 1200)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lists = trials.spread_candidates(trials.day_bounds(df.select("symbol", "day").distinct()), ["symbol", "day"], 20)
        plan = trials.score_candidates(df, ["symbol", "day"], lists, 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning(symbol") == 2  # the dealt union, and the distinct days that the lists come from
    assert plan.count("Sort [") == 1 and "Join" not in plan and "Window" not in plan


def test_measures_of_a_candidate_are_those_of_its_bars(spark):
    df = walk(spark, [("a", 0, 4000)])
    made = bars.candidate_bars(df, ["symbol", "day"], GRID, 5).orderBy("param_id", "bar_id").toPandas()
    for r in trials.score_candidates(df, ["symbol", "day"], GRID, 5).collect():
        own = made[made.param_id == r.param_id]
        returns = np.diff(np.log(own.close.to_numpy()))
        assert r.bars == len(own) and r.mean_ticks == pytest.approx(own.n_ticks.mean())
        assert r.quality_score == pytest.approx(stats.quality_score(returns, own.n_ticks.to_numpy(dtype=float)))
        assert r.cv_ticks == pytest.approx(own.n_ticks.std(ddof=0) / own.n_ticks.mean())
        if len(returns) >= 14:
            assert r.std_return == pytest.approx(returns.std(ddof=1)) and r.sharpe_ratio == pytest.approx(returns.mean() / returns.std(ddof=1) * 252**0.5)
            assert r.is_stationary == (stats.adf_p_value(stats.adf_statistic(returns, 5)[0]) < 0.05)


def test_too_few_bars_for_measures():
    assert trials.measures(np.array([]), np.array([])) == (0, *[None] * 7)
    assert trials.measures(np.array([5.0]), np.array([7]))[:3] == (1, 7.0, 0.0)
    flat = trials.measures(np.full(30, 5.0), np.full(30, 7))
    assert flat[0] == 30 and flat[3] is None and flat[6:] == (0.0, 0.0)


def test_a_search_stops_at_the_first_candidate_with_twice_enough(spark):
    df = walk(spark, [("a", 0, 6000), ("b", 0, 500), ("c", 0, 99)])
    slow = [(0, 0.999, 200.0), (1, 0.999, 40.0), (2, 0.999, 100.0), (3, 0.999, 8.0)]
    counts = {(r.symbol, r.param_id): r.bars for r in trials.score_candidates(df, ["symbol", "day"], slow, 5).collect()}
    enough = counts["a", 1] // 2  # candidate 1 reaches it, 3 would have more bars but comes later
    assert counts["a", 3] > counts["a", 1] > counts["a", 0]
    found = {r.symbol: r for r in trials.day_search(df, ["symbol", "day"], slow, 5, enough=enough).collect()}
    assert set(found) == {"a", "b"}  # c has fewer ticks than a search needs
    assert (found["a"].param_id, found["a"].bars, found["a"].meets) == (1, counts["a", 1], True)
    best = max(c for (s, _), c in counts.items() if s == "b")
    assert (found["b"].bars, found["b"].meets) == (best, False)
    none = trials.day_search(df, ["symbol", "day"], slow, 5, least_bars=10_000)
    assert none.collect() == []


def test_failed_days_recover_with_the_best_scoring_candidate(spark):
    df = walk(spark, [("a", 0, 3000), ("a", 1, 3000), ("a", 2, 40), ("b", 0, 30)])
    failed = df.select("symbol", "day").distinct().unionByName(spark.createDataFrame([("a", datetime.date(2024, 3, 9))], "symbol string, day date"))
    studies = spark.createDataFrame([("a", "2024-01", 0.99, 60.0), ("a", "2024-02", 0.99, 9000.0)], "symbol string, period string, exp_lambda double, init_exp_t double")
    lists = {(r.symbol, r.day): r.candidates for r in trials.failed_day_candidates(failed, studies, 8, least_t=10.0).collect()}
    assert all(30 <= c.init_exp_t <= 90 and 0.99 <= c.exp_lambda <= 0.999 for c in lists["a", START.date()])  # the study before the month before
    assert all(1000 <= c.init_exp_t <= 3000 for c in lists["b", START.date()])  # the default
    found = {r.symbol: r for r in trials.failed_day_search(df, failed, studies, 8, 5, 20, least_t=10.0).collect()}
    assert found["a"].days == 3 and found["a"].success_rate == pytest.approx(2 / 3)  # days without ticks do not count
    assert (found["b"].score, found["b"].param_id, found["b"].successes) == (0.0, 0, 0)
    days = trials.score_candidates(df.where("symbol = 'a'"), ["symbol", "day"], [tuple(c) for c in lists["a", START.date()]], 5).toPandas()
    scores = {}
    for i, own in days.groupby("param_id"):
        won = own[own.bars >= 20]
        rate = len(won) / len(own)
        scores[i] = 0.0 if rate < 0.4 else 50 * rate + 0.35 * won.quality_score.mean() + 0.15 * max(0, 100 - won.quality_score.std(ddof=0))
    assert found["a"].score == pytest.approx(max(scores.values())) and found["a"].param_id == max(scores, key=lambda i: (scores[i], -i))
    again = trials.recovered_bars(df, failed, trials.failed_day_search(df, failed, studies, 8, 5, 20, least_t=10.0), 5, 20)
    assert {(r.symbol, r.day.day) for r in again.select("symbol", "day").distinct().collect()} == {("a", 1), ("a", 2)}
