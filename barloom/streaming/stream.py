"""Structured Streaming forms of deduplication, clock bars and the run-bar fold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.operators import bars
from barloom.operators.bars import _ohlcv
from barloom.sources import sinks


def drain(out: DataFrame) -> DataFrame:
    """Runs a stream over the data there is, into Parquet in the session's shared folder, and reads it back."""
    spark = out.sparkSession
    path = sinks.scratch(spark, "stream")
    schema = out.schema
    query = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/out")


def event_time(ticks: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a time with zone; times are UTC."""
    return ticks.withColumn(column, F.col(column).cast("timestamp"))


def deduplicated(ticks: DataFrame, late: str = "1 hour") -> DataFrame:
    return event_time(ticks).withWatermark("ts", late).dropDuplicatesWithinWatermark(["symbol", "id"])


def time_bars(ticks: DataFrame, minutes: int, late: str = "1 hour") -> DataFrame:
    """Append mode gives each clock bar once, when the watermark has passed it."""
    rows = event_time(ticks).withWatermark("ts", late)
    grouped = rows.groupBy("symbol", F.window("ts", f"{minutes} minutes").alias("w")).agg(*_ohlcv())
    return grouped.select("symbol", F.col("w.start").alias("open_time"), F.col("w.end").alias("close_time"), "open", "high", "low", "close", "n_ticks", "volume", "dollar")


_STATE = f"ready boolean, {bars.SNAPSHOT}, price_before double, b_before double, warm array<struct<us:long,price:double,quantity:double,b:double>>"
_BARS = "symbol string, bar_id long, open_time timestamp, close_time timestamp, open double, high double, low double, close double, n_ticks long, volume double, dollar double"


def run_bars(ticks: DataFrame, lam: float, t0: float, min_ticks: int, warm_up: int = 100) -> DataFrame:
    """Run bars per symbol, tick rule, with a state of fixed size; the ticks of a batch are folded as arrays.

    Batches must arrive in time order.  The warm-up is always ``warm_up``
    ticks (at most 100): a stream has no length, so this equals the batch fold
    for scopes of at least ``10 * warm_up`` ticks.
    """
    size = len(bars.SNAPSHOT.split(", "))
    names = [c.split()[0] for c in _BARS.split(", ")]

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fold = bars._Fold("run", 10 * warm_up, lam, t0, min_ticks)
        price_before, b_before = None, 1.0
        if state.exists:
            ready, *kept, price_before, b_before, warm = state.get
            if ready:
                fold.restore(tuple(kept))
            elif warm:
                us, price, quantity, b = (np.array(c, dtype=float if i else np.int64) for i, c in enumerate(zip(*warm, strict=True)))
                fold.feed(us, price, quantity, price * quantity, b)
        rows = pd.concat(list(frames)).sort_values(["ts", "id"])
        us = rows["ts"].to_numpy(dtype="datetime64[us]").astype("int64")
        price, quantity = rows["price"].to_numpy(dtype=float), rows["quantity"].to_numpy(dtype=float)
        b = bars.tick_directions(price, price_before, b_before)
        fold.feed(us, price, quantity, price * quantity, b)
        warm = [] if fold.ready else [(int(u), float(p), float(q), float(d)) for part in fold.held for u, p, q, _, d in zip(*part, strict=True)]
        kept = fold.snapshot() if fold.ready else (None,) * size
        state.update((fold.ready, *kept, float(price[-1]), float(b[-1]), warm))
        made = pd.DataFrame([(key[0], *bar) for bar in fold.bars], columns=names)
        yield made.assign(**{c: pd.to_datetime(made[c].astype("int64"), unit="us") for c in ("open_time", "close_time")})

    rows = event_time(ticks).select("symbol", "id", "ts", "price", "quantity")
    return rows.groupBy("symbol").applyInPandasWithState(step, _BARS, _STATE, "append", GroupStateTimeout.NoTimeout)


#: Bars of each symbol that features look back on.
TAIL = 600


def bar_features(new_bars: DataFrame, path: str, features: Callable[[DataFrame], DataFrame], tail: int = TAIL) -> DataStreamWriter:
    """A stream of bars to their features, each batch computed by the batch operators behind the last ``tail`` bars before it.

    ``features`` maps bars to rows with the same ``symbol`` and ``bar_id``.
    The tail after batch n is the table ``path/tail/batch=n``, and its features
    are ``path/out/batch=n``; a batch that is run again after a failure reads
    the tail before it and overwrites its own.  Start the writer with a
    checkpoint of its own.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read twice, folded once
        before, after, out = f"{path}/tail/batch={number - 1}", f"{path}/tail/batch={number}", f"{path}/out/batch={number}"
        rows = batch
        if sinks.exists(spark, f"{before}/_SUCCESS"):
            rows = spark.read.schema(batch.schema).parquet(before).unionByName(batch)
        made = features(rows).join(batch.select("symbol", "bar_id"), ["symbol", "bar_id"], "left_semi")
        made.write.mode("overwrite").parquet(out)
        newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("bar_id")))
        rows.withColumn("_r", newest).where(F.col("_r") <= tail).drop("_r").write.mode("overwrite").parquet(after)
        batch.unpersist()
        sinks.remove(spark, f"{path}/tail/batch={number - 2}")

    return new_bars.writeStream.foreachBatch(take)
