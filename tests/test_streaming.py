import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import bars, features, ticks
from barloom.streaming import stream

START = datetime.datetime(2024, 1, 1)
COLUMNS = ["symbol", "bar_id", "n_ticks", "close", *[c for c in features.BAR_FEATURES if c != "bar_duration_secs"]]


@pytest.fixture(scope="module")
def tick_files(spark, tmp_path_factory):
    """Five files of ticks in time order, as a stream reads them; the first has fewer than a warm-up."""
    rng = np.random.default_rng(12)
    folder, at = str(tmp_path_factory.mktemp("ticks")), 0
    for part, n in enumerate([60, 900, 1500, 10, 1500]):
        rows = []
        for symbol in "ab":
            price = 100 + np.cumsum(rng.normal(size=n)).round(1) / 10
            rows += [(symbol, at + i, START + datetime.timedelta(seconds=at + i), float(p), float(q)) for i, (p, q) in enumerate(zip(price, rng.integers(1, 9, n), strict=True))]
        at += n
        df = spark.createDataFrame(rows, "symbol string, id long, ts timestamp_ntz, price double, quantity double").coalesce(1)
        df.write.mode("append").parquet(f"{folder}/part={part}")
    return folder


def all_ticks(spark, folder):
    return spark.read.parquet(folder).drop("part").withColumn("dollar", F.col("price") * F.col("quantity"))


def batch_bars(spark, folder):
    return bars.run_bars(ticks.with_direction(all_ticks(spark, folder), ["symbol"]), ["symbol"], 0.95, 12, 5)


def streamed(spark, folder, parts):
    schema = all_ticks(spark, folder).drop("dollar").schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/part={{{','.join(map(str, parts))}}}")
    return stream.run_bars(rows.withColumn("dollar", F.col("price") * F.col("quantity")), 0.95, 12, 5)


def test_the_stream_folds_as_the_batch_does(spark, tick_files):
    out = stream.drain(streamed(spark, tick_files, range(5)))
    names = ["symbol", "bar_id", "open", "high", "low", "close", "n_ticks", "volume"]
    want = sorted(tuple(r) for r in batch_bars(spark, tick_files).select(names).collect())
    found = sorted(tuple(r) for r in out.select(names).collect())
    assert len(found) > 300 and found == [pytest.approx(r) for r in want]


def test_a_fold_taken_up_from_its_snapshot_goes_on(spark):
    rng = np.random.default_rng(1)
    price, quantity = 100 + np.cumsum(rng.normal(size=3000)), rng.integers(1, 9, 3000).astype(float)
    ts, b = np.arange(3000), np.where(rng.random(3000) < 0.5, 1.0, -1.0)
    for kind in ("run", "imbalance"):
        whole = bars._Fold(kind, 3000, 0.95, 12.0, 5)
        whole.feed(ts, price, quantity, price * quantity, b)
        made, fold = [], bars._Fold(kind, 3000, 0.95, 12.0, 5)
        for lo in range(0, 3000, 250):
            s = slice(lo, lo + 250)
            fold.feed(ts[s], price[s], quantity[s], (price * quantity)[s], b[s])
            made, kept = made + fold.bars, fold.snapshot()
            assert len(kept) == len(bars.SNAPSHOT.split(", ")) and all(v is None or isinstance(v, int | float) for v in kept)
            fold = bars._Fold(kind, 3000, 0.95, 12.0, 5)
            fold.restore(kept)
        assert [x[:8] for x in made] == [x[:8] for x in whole.bars]


def test_stream_features_are_batch_features_across_a_restart(spark, tick_files, tmp_path):
    path = str(tmp_path / "features")

    def run(features_of, tail):
        made = streamed(spark, tick_files, range(5))
        writer = stream.bar_features(made, path, features_of, tail).option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
        query = writer.start()
        query.awaitTermination()

    calls = []

    def dies_in_the_third_batch(rows):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return features.bar_features(rows)

    with pytest.raises(Exception, match="lost"):
        run(dies_in_the_third_batch, 400)
    run(features.bar_features, 400)
    found = sorted(tuple(r) for r in spark.read.parquet(f"{path}/out").select(COLUMNS).collect())
    want = sorted(tuple(r) for r in features.bar_features(batch_bars(spark, tick_files)).select(COLUMNS).collect())
    assert len(found) == len(want) and all(len(r) == len(COLUMNS) for r in found)
    for a, b in zip(found, want, strict=True):
        assert a[:3] == b[:3] and [v is None for v in a] == [v is None for v in b]
        assert [v for v in a[3:] if v is not None] == pytest.approx([v for v in b[3:] if v is not None], rel=1e-7, abs=1e-9)
    assert spark.read.parquet(f"{path}/tail").groupBy("symbol", "batch").count().where("count > 400").isEmpty()
