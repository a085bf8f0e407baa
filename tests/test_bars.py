import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.operators import bars, ticks
from barloom.operators.bars import _Fold


def plain_fold(kind, price, dollar, b, lam, t0, min_ticks):
    """The fold tick by tick."""
    n = len(b)
    w = min(100, n // 10)
    if w == 0:
        return []
    up = b[:w] == 1
    p, e_t = up.sum() / w, t0
    e = [dollar[:w][m].mean() if m.any() else dollar[:w].mean() for m in (up, ~up)]
    e_v = dollar[:w].mean()
    runs, theta, start, out = [0.0, 0.0], 0.0, 0, []
    for i in range(1, n):
        runs[0 if b[i] == 1 else 1] += dollar[i]
        theta += b[i] * dollar[i]
        t = i - start + 1
        reached = max(runs) >= e_t * max(p * e[0], (1 - p) * e[1]) if kind == "run" else abs(theta) >= e_t * e_v * abs(2 * p - 1)
        if reached and t >= min_ticks:
            part, side = dollar[start : i + 1], b[start : i + 1] == 1
            out.append((start, i + 1))
            e_t = (1 - lam) * t + lam * e_t
            p = (1 - lam) * side.mean() + lam * p
            for s, m in enumerate((side, ~side)):
                if m.any():
                    e[s] = (1 - lam) * part[m].mean() + lam * e[s]
            e_v = (1 - lam) * part.mean() + lam * e_v
            runs, theta, start = [0.0, 0.0], 0.0, i + 1
    return out


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([5, 9, 10, 57, 400, 1500]), st.sampled_from([(0.9975, 200.0, 40), (0.9, 8.0, 5), (0.5, 3.0, 1), (0.99, 30.0, 20)]), st.sampled_from(["run", "imbalance"]), st.integers(1, 400))
def test_fold_equals_plain_loop(seed, n, params, kind, batch):
    rng = np.random.default_rng(seed)
    price = 100 + np.cumsum(rng.normal(size=n))
    quantity = rng.integers(1, 50, n).astype(float)
    dollar = np.abs(price) * quantity
    b = np.where(rng.random(n) < rng.choice([0.3, 0.5, 0.8]), 1.0, -1.0)
    fold = _Fold(kind, n, *params)
    ts = np.arange(n)
    for lo in range(0, n, batch):
        s = slice(lo, lo + batch)
        fold.feed(ts[s], price[s], quantity[s], dollar[s], b[s])
    want = plain_fold(kind, price, dollar, b, *params)
    assert [(x[1], x[2] + 1) for x in fold.bars] == want
    for bar, (lo, hi) in zip(fold.bars, want, strict=True):
        assert bar[3] == price[lo] and bar[6] == price[hi - 1] and bar[4] == price[lo:hi].max() and bar[5] == price[lo:hi].min()
        assert bar[7] == hi - lo and bar[8] == pytest.approx(quantity[lo:hi].sum()) and bar[9] == pytest.approx(dollar[lo:hi].sum())


def added_up(x):
    total = 0.0
    for v in x:
        total += v
    return total


def tick_by_tick(dollar, b, lam, t0, min_ticks):
    """The run fold with every sum added up from zero, one tick after the other: a run that meets the threshold exactly is decided like this."""
    w = min(100, len(b) // 10)
    up, new = b[:w] == 1, 1 - lam
    p, e_t = up.sum() / w, t0
    e = [added_up(dollar[:w][m]) / m.sum() if m.any() else added_up(dollar[:w]) / w for m in (up, ~up)]
    runs, sums, counts, out = [0.0, 0.0], [0.0, 0.0], [0, 0], []
    for i, d in enumerate(dollar):
        side = 0 if b[i] == 1 else 1
        runs[side] += d if i else 0.0
        sums[side] += d
        counts[side] += 1
        t = sum(counts)
        if i and t >= min_ticks and max(runs) >= e_t * max(p * e[0], (1 - p) * e[1]):
            out.append(i)
            e_t, p = new * t + lam * e_t, new * counts[0] / t + lam * p
            e = [new * sums[s] / counts[s] + lam * e[s] if counts[s] else e[s] for s in (0, 1)]
            runs, sums, counts = [0.0, 0.0], [0.0, 0.0], [0, 0]
    return out


@pytest.mark.parametrize("copies", [1, 6, 60])
def test_runs_that_meet_the_threshold_exactly(copies):
    """Copies of a tick make such ties; they fall alike whatever came before the bar and however ticks are dealt."""
    for seed in range(20):
        rng = np.random.default_rng(seed)
        price = np.repeat(np.round(rng.exponential(50, 4000 // copies) + 0.01, 2), copies)
        dollar = price * np.repeat(rng.integers(1, 100, 4000 // copies), copies).astype(float)
        b = bars.tick_directions(price, None)
        want = tick_by_tick(dollar, b, 0.95, 20.0, 5)
        for batch in (len(price), 333):
            fold = _Fold("run", len(price), 0.95, 20.0, 5)
            for lo in range(0, len(price), batch):
                s = slice(lo, lo + batch)
                fold.feed(np.arange(len(price))[s], price[s], dollar[s], dollar[s], b[s])
            assert [int(x[2]) for x in fold.bars] == want


def test_audit_reconciles_and_order_does_not_matter(spark):
    rng = np.random.default_rng(4)
    rows = [("s" + str(i % 2), i, i, float(100 + rng.normal()), float(rng.integers(1, 9))) for i in range(3000)]
    df = spark.createDataFrame(rows, "symbol string, id long, n long, price double, quantity double")
    df = df.selectExpr("symbol", "id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, n) as ts", "price", "quantity", "price * quantity as dollar")
    found = bars.run_bars(ticks.with_direction(df, ["symbol"]), ["symbol"], 0.9, 20, 10)
    again = bars.run_bars(ticks.with_direction(df.orderBy("price").repartition(7), ["symbol"]), ["symbol"], 0.9, 20, 10)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, again.collect()))
    for r in bars.audit_bars(df, found, ["symbol"]).collect():
        assert r.clean == r.consumed + r.residual and r.bars > 5
    bad = bars.invariants(found, ["symbol"]).collect()
    assert all(r.overlaps == r.high_low == r.low_high == r.negative == r.empty == r.closes_early == 0 for r in bad)


def test_mad_filter_is_causal_and_drops_a_spike(spark):
    rng = np.random.default_rng(1)
    prices = [*(100 + 0.1 * rng.normal(size=200)), 100_000.0, 100.0]
    make = lambda values: spark.createDataFrame([("s", i, float(p), 1.0) for i, p in enumerate(values)], "symbol string, id long, price double, quantity double").selectExpr("*", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as ts")
    kept = {r.id for r in ticks.mad_filter(make(prices), ["symbol"], 20, 5.0).collect()}
    assert 200 not in kept and 201 in kept
    assert kept - {201} == {r.id for r in ticks.mad_filter(make(prices[:-1]), ["symbol"], 20, 5.0).collect()}


def test_policies_and_modes_are_checked(spark, sf_dir):
    from barloom.sources import tables

    rows = tables.ticks(spark, sf_dir)
    with pytest.raises(ValueError):
        ticks.deduplicate(rows, "fuzzy")
    with pytest.raises(ValueError):
        ticks.with_direction(rows, ["symbol"], "guess")
    without = ticks.with_direction(rows.drop("is_buyer_maker"), ["symbol"], "aggressor").collect()
    assert sorted(r.b for r in without) == sorted(r.b for r in ticks.with_direction(rows, ["symbol"]).collect())
