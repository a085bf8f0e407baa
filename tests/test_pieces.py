import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import joins, pieces, ticks

START = datetime.datetime(2024, 1, 1)
SCHEMA = "symbol string, id long, ts timestamp_ntz, price double, quantity double"


def plain_mad(prices, width):
    """Scores of one scope from the definition."""
    out, devs, mad = [], [], None
    for i, p in enumerate(prices):
        med = np.median(prices[i - width + 1 : i + 1]) if i >= width - 1 else None
        devs.append(None if med is None else abs(p - med))
        if i >= 2 * width - 2:
            raw = np.median(devs[-width:])
            mad = raw if raw else mad
        out.append(None if mad is None or devs[-1] is None else 0.6745 * devs[-1] / mad)
    return out


def series(rng, n, flat):
    price = 100 + np.cumsum(rng.normal(size=n)).round(0)
    price[flat : flat + n // 3] = 50.0  # zero deviations: the last positive one is carried over pieces
    return price


@pytest.mark.parametrize("width", [1, 2, 7, 20])
def test_scores_of_pieces_are_those_of_the_whole(spark, width):
    rng = np.random.default_rng(width)
    scopes = {"hot": series(rng, 900, 300), "warm": series(rng, 150, 10), "short": series(rng, 5, 0)}
    at = {s: np.cumsum(rng.choice([0, 1, 30, 900], size=len(p))) for s, p in scopes.items()}
    rows = [(s, i, START + datetime.timedelta(seconds=int(at[s][i])), float(v), 1.0) for s, p in scopes.items() for i, v in enumerate(p)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = {(s, i): v for s, p in scopes.items() for i, v in enumerate(plain_mad(p, width))}
    for piece_rows in (None, 40, 200, 10_000):
        found = {(r.symbol, r.id): r.mad_z for r in ticks.mad_scores(df, ["symbol"], width, piece_rows).collect()}
        assert found.keys() == want.keys()
        for key, v in want.items():
            assert found[key] == (None if v is None else pytest.approx(v)), (key, piece_rows)


def test_rows_without_a_price_score_as_a_window_would(spark):
    rows = [("a", i, START + datetime.timedelta(seconds=i), None if i == 6 else float(i % 4), 1.0) for i in range(20)] + [(None, 0, START, 1.0, 1.0)]
    found = {r.id: r.mad_z for r in ticks.mad_scores(spark.createDataFrame(rows, SCHEMA), ["symbol"], 3).where("symbol = 'a'").collect()}
    assert found[5] is not None and [found[i] for i in (6, 7, 8)] == [None] * 3 and found[19] is not None


def test_one_symbol_is_work_for_many_tasks(spark):
    df = spark.range(4000).select(F.lit("hot").alias("symbol"), "id", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, id * 60)").alias("ts"), (F.col("id") % 17).cast("double").alias("price"), F.lit(1.0).alias("quantity"))
    table = pieces.cut_keys(df, ["symbol"], "ts", 200, 600)
    sizes = pieces.in_pieces(df, table, ["symbol"], "ts", 600).groupBy("_piece").count().orderBy("_piece").collect()
    assert len(sizes) == 20 and all(r["count"] == 200 for r in sizes)
    scored = ticks.mad_scores(df, ["symbol"], 10, piece_rows=200)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        used = ticks.mad_scores(df, ["symbol"], 10, piece_rows=200).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert used == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert scored.count() == 4000


def test_pieces_of_uneven_buckets(spark):
    rows = [("a", i, START + datetime.timedelta(seconds=s), 1.0, 1.0) for i, s in enumerate([0] * 95 + [700] * 3 + [1300] * 300 + [2000, 90_000, 90_001])]
    rows += [("b", 0, START, 1.0, 1.0), (None, 1, START, 1.0, 1.0), ("a", 1000, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    placed = pieces.in_pieces(df, pieces.cut_keys(df.dropna(subset=["symbol", "ts"]), ["symbol"], "ts", 96, 600), ["symbol"], "ts", 600)
    sizes = {(r.symbol, r._piece): r["count"] for r in placed.groupBy("symbol", "_piece").count().collect()}
    assert sizes == {("a", 0): 98, ("a", 1): 300, ("a", 2): 3, ("b", 0): 1}


@pytest.mark.parametrize("strict", [False, True])
def test_asof_in_pieces_is_the_plain_one(spark, strict):
    rng = np.random.default_rng(3)
    seconds = np.sort(rng.integers(0, 40_000, 600))
    left = [("k", int(i), START + datetime.timedelta(seconds=int(s))) for i, s in enumerate(seconds)] + [("other", -1, START), (None, -2, START), ("k", -3, None)]
    right = [("k", START + datetime.timedelta(seconds=int(s)), float(i), None if i % 5 == 0 else i) for i, s in enumerate(rng.choice(seconds, 25, replace=False))] + [(None, START, 0.5, 1), ("unseen", START, 0.5, 1)]
    a = spark.createDataFrame(left, "key string, id int, at timestamp_ntz")
    b = spark.createDataFrame(right, "key string, since timestamp_ntz, v double, w int")
    options = dict(left_on="at", right_on="since", by=["key"], values=["v", "w"], strict=strict)
    plain = {r.id: (r.v, r.w) for r in joins.asof_backward(a.dropna(), b, **options).collect()} | {-2: (None, None), -3: (None, None)}
    for piece_rows in (1, 30, 10_000):
        found = joins.asof_backward(a, b, piece_rows=piece_rows, **options)
        assert found.columns == ["key", "id", "at", "v", "w"]
        assert {r.id: (r.v, r.w) for r in found.collect()} == plain
