"""Days of ticks from a local store first, and from a registered fallback where the store lacks them.

The store is scanned by Spark with its days pruned; a day it lacks is one
partition of a Python data source, which asks the fallback, waits and asks
again.  What comes back says where it is from.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Seconds to wait before each attempt but the first, whose number says how many attempts there are.
RETRY_DELAYS = (120.0, 300.0, 600.0)
#: Columns of a fallback's answer.
FETCHED = "symbol string, day date, id bigint, ts timestamp_ntz, price double, quantity double, is_buyer_maker boolean"
_ARROW = pa.schema([("id", pa.int64()), ("ts", pa.timestamp("us")), ("price", pa.float64()), ("quantity", pa.float64()), ("is_buyer_maker", pa.bool_())])

#: A day's ticks (columns of ``FETCHED`` without symbol and day) for ``(symbol, "YYYY-MM-DD")``; None or no rows: not there.
Fetch = Callable[[str, str], pa.Table | None]


class DayPartition(InputPartition):
    def __init__(self, symbol: str, day: str):
        super().__init__((symbol, day))
        self.symbol, self.day = symbol, day


def attempted(fetch: Fetch, symbol: str, day: str, delays: tuple[float, ...], wait: Callable[[float], None] = time.sleep) -> pa.Table | None:
    """The first answer with rows; an error or an empty answer is asked for again after the next delay, and is None after the last."""
    for attempt in range(max(1, len(delays))):
        if attempt:
            wait(delays[attempt])
        try:
            found = fetch(symbol, day)
        except Exception:
            continue
        if found is not None and found.num_rows:
            return found
    return None


class _DayReader(DataSourceReader):
    def __init__(self, fetch: Fetch, wanted: list[list[str]], delays: tuple[float, ...]):
        self.fetch, self.wanted, self.delays = fetch, wanted, delays

    def partitions(self) -> list[InputPartition]:
        return [DayPartition(symbol, day) for symbol, day in self.wanted]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, DayPartition):  # a request without days
            return
        found = attempted(self.fetch, partition.symbol, partition.day, self.delays)
        if found is None:
            return
        for batch in found.select(_ARROW.names).cast(_ARROW).to_batches(max_chunksize=100_000):
            if not batch.num_rows:  # a chunk that a filter emptied
                continue
            keys = [pa.array([partition.symbol] * batch.num_rows, pa.string()), pa.array([partition.day] * batch.num_rows, pa.string()).cast(pa.date32())]
            yield pa.RecordBatch.from_arrays([*keys, *batch.columns], names=["symbol", "day", *_ARROW.names])


def register_fallback(spark: SparkSession, name: str, fetch: Fetch) -> None:
    """Makes ``fetch`` readable as the format ``name``; options: ``days`` (JSON, pairs of symbol and day), ``delays`` (JSON, seconds)."""

    class Fallback(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return FETCHED

        def reader(self, schema) -> DataSourceReader:
            return _DayReader(fetch, json.loads(self.options["days"]), tuple(json.loads(self.options.get("delays", json.dumps(RETRY_DELAYS)))))

    spark.dataSource.register(Fallback)


def acquire_days(local: DataFrame, wanted: DataFrame, fallback: str | None = None, mode: str = "auto", delays: tuple[float, ...] = RETRY_DELAYS) -> DataFrame:
    """Ticks of the wanted days (``symbol, day``) with ``source``: ``local`` or the fallback's name.

    ``mode``: ``local`` (the store only), ``remote`` (the fallback only) or
    ``auto`` (the store, and the fallback for days without a row there).  Days
    that neither has are absent.  The days to ask for, a list that one request
    bounds, pass through the driver; ticks do not.
    """
    if mode not in ("local", "remote", "auto"):
        raise ValueError(f"unknown mode: {mode}")
    if mode != "local" and fallback is None:
        raise ValueError(f"mode {mode} needs a fallback")
    spark, keys = local.sparkSession, ["symbol", "day"]
    wanted = wanted.select(F.col("symbol"), F.col("day").cast("date").alias("day")).dropna().distinct()
    columns = [c.split()[0] for c in FETCHED.split(", ")]
    parts = []
    missing = wanted
    if mode != "remote":
        parts.append(local.join(wanted, keys, "left_semi").select(*columns, F.lit("local").alias("source")))
        missing = wanted.join(local.select(*keys).distinct(), keys, "left_anti")
    if mode != "local":
        days = [[r.symbol, str(r.day)] for r in missing.collect()]
        if days:
            asked = spark.read.format(fallback).option("days", json.dumps(sorted(days))).option("delays", json.dumps(list(delays))).load()
            parts.append(asked.select(*columns, F.lit(fallback).alias("source")))
    if not parts:
        return spark.createDataFrame([], FETCHED + ", source string")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
