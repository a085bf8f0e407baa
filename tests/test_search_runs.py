import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import search, trials
from barloom.plans import search_runs

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def market(spark):
    """Ten days of 600 ticks for two symbols."""
    rng = np.random.default_rng(8)
    rows = []
    for symbol in "ab":
        for day in range(10):
            price = 100 + np.cumsum(rng.normal(size=600)).round(1)
            at = START + datetime.timedelta(days=day)
            rows += [(symbol, at.date(), i, at + datetime.timedelta(seconds=i), float(abs(p) + 1), float(q)) for i, (p, q) in enumerate(zip(price, rng.integers(1, 9, 600), strict=True))]
    df = spark.createDataFrame(rows, "symbol string, day date, id long, ts timestamp_ntz, price double, quantity double")
    return df.withColumn("dollar", F.col("price") * F.col("quantity")).cache()


def lists_of(spark, n):
    bounds = spark.createDataFrame([(s, 5.0, 60.0, 0.9, 0.999) for s in "ab"], "symbol string, t_min double, t_max double, lambda_min double, lambda_max double")
    return trials.spread_candidates(bounds, ["symbol"], n)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_halving_finds_the_winner_of_the_full_grid_with_less_work(spark, market, tmp_path):
    n, path = 12, str(tmp_path / "halving")
    lists = lists_of(spark, n)
    found = search_runs.halving_search(market, lists, path, (0.2, 0.5, 1.0), 5, 15)
    winners = {r.symbol: r.param_id for r in found.where("rank = 1").collect()}
    full = trials.score_candidates(market, ["symbol", "day"], market.select("symbol", "day").distinct().join(lists, "symbol"), 5)
    grid = search.composite_score(full.withColumnRenamed("quality_score", "quality"), ["symbol", *search_runs.CANDIDATE], 15, float("inf"))
    best = {}
    for r in grid.orderBy("symbol", F.desc("score"), "param_id").collect():
        best.setdefault(r.symbol, r)
    assert winners == {s: r.param_id for s, r in best.items()}
    assert {r.symbol: r.score for r in found.where("rank = 1").collect()} == pytest.approx({s: r.score for s, r in best.items()})
    folded = sum(spark.read.parquet(f"{path}/round={r}").count() for r in range(3))
    assert folded < 0.6 * full.count() == 0.6 * n * 20
    assert {r.days for r in found.collect()} == {10}


def test_a_stopped_halving_search_goes_on(spark, market, tmp_path, monkeypatch):
    path, lists = str(tmp_path / "h"), lists_of(spark, 6)
    whole = search_runs.halving_search(market, lists, str(tmp_path / "whole"), (0.3, 1.0), 5, 15).orderBy("symbol", "rank").collect()
    scored = trials.score_candidates

    def dies(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(search_runs, "survivors", dies)
        with pytest.raises(RuntimeError, match="lost"):
            search_runs.halving_search(market, lists, path, (0.3, 1.0), 5, 15)
    before = files(path)
    assert search_runs.halving_search(market, lists, path, (0.3, 1.0), 5, 15).orderBy("symbol", "rank").collect() == whole
    assert before.items() <= files(path).items() and scored is trials.score_candidates


def test_a_year_resumes_after_a_stop_to_the_same_table(spark, market, tmp_path, monkeypatch):
    windows = [(f"w{i}", f"2024-01-{1 + 2 * i:02d}", f"2024-01-{3 + 2 * i:02d}") for i in range(5)]
    bounds = spark.createDataFrame([("a", 10.0, 60.0, 0.9, 0.99), ("b", 10.0, 60.0, 0.9, 0.99), ("idle", 10.0, 60.0, 0.9, 0.99)], "symbol string, t_min double, t_max double, lambda_min double, lambda_max double")
    run = lambda path: search_runs.year_search(market, windows, bounds, path, 6, 5, 5)
    key = ["window", "symbol", "param_id"]
    whole = run(str(tmp_path / "whole")).orderBy(key).collect()
    assert len(whole) == 5 * (2 * 6 + 1) and {(r.t_min, r.t_max) for r in whole if r.symbol == "idle"} == {(10.0, 60.0)}
    assert len({(r.t_min, r.t_max) for r in whole if r.symbol == "a"}) > 1  # the bounds follow the trials
    path, calls, scored = str(tmp_path / "stopped"), [], trials.score_candidates

    def counted(*args, **options):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("killed")
        return scored(*args, **options)

    monkeypatch.setattr(search_runs.trials, "score_candidates", counted)
    with pytest.raises(RuntimeError, match="killed"):
        run(path)
    before = files(path)
    assert sorted(os.listdir(path)) == ["window=w0", "window=w1", "window=w2"]
    assert run(path).orderBy(key).collect() == whole
    assert len(calls) == 4 + 2 and before.items() <= files(path).items()


def plain_stop(rows, pruned, stale):
    row = age = 0
    best = seen = None
    for i, (trial, state, value) in enumerate(rows, 1):
        if state == "PRUNED":
            row, age = row + 1, age + 1
            if row >= pruned:
                return i, trial, "pruned"
        elif state == "COMPLETE":
            row, best = 0, value if best is None else max(best, value)
            if best > 0 and (seen is None or best > seen + 1e-6):
                seen, age = best, 0
            else:
                age += 1
                if best > 0 and age >= stale:
                    return i, trial, "no improvement"
        else:
            row = 0
    return len(rows), None, None


def test_early_stops_against_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    studies = {s: [(t, str(rng.choice(["PRUNED", "COMPLETE", "FAIL"], p=[0.4, 0.5, 0.1])), float(rng.choice([-1.0, 0.0, 1.0, 1.0 + 5e-7, 2.0, rng.random()]))) for t in range(rng.integers(1, 40))] for s in range(40)}
    rows = [(s, t, state, value if state == "COMPLETE" else None) for s, own in studies.items() for t, state, value in own]
    df = spark.createDataFrame(rows, "study int, trial int, state string, value double").repartition(5)
    found = {r.study: (r.ran, r.stopped_at, r.reason) for r in search.stopped_early(df, ["study"], 3, 5).collect()}
    assert found == {s: plain_stop(own, 3, 5) for s, own in studies.items()}
    assert {r[2] for r in found.values()} == {"pruned", "no improvement", None}
