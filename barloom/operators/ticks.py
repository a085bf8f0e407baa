"""Validation, deduplication, outlier filter, direction and audit of ticks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import pieces

ORDER = ["ts", "id"]


def is_sane() -> Column:
    """Positive price and quantity at a known time; null and NaN are neither (Spark sorts NaN above all numbers)."""
    positive = [(F.col(c) > 0) & ~F.isnan(c) for c in ("price", "quantity")]
    return F.coalesce(positive[0] & positive[1] & F.col("ts").isNotNull(), F.lit(False))


def sane(ticks: DataFrame) -> DataFrame:
    # Plain comparisons first: they reach the scan.
    return ticks.where((F.col("price") > 0) & (F.col("quantity") > 0) & ~F.isnan("price") & ~F.isnan("quantity"))


def deduplicate(ticks: DataFrame, policy: str = "exact") -> DataFrame:
    """One row per ``(symbol, id)``, or per ``(symbol, ts, price, quantity)`` where the id is null or the frame has none; the least in its other columns."""
    if policy == "none":
        return ticks
    if policy != "exact":
        raise ValueError(f"unknown dedup policy: {policy}")
    if "id" not in ticks.columns:
        keys = ["symbol", "ts", "price", "quantity"]
        rest = [c for c in ticks.columns if c not in keys]
        if not rest:
            return ticks.distinct()
        return ticks.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row")).select(*keys, "row.*").select(ticks.columns)
    key = F.when(F.col("id").isNull(), F.struct("ts", "price", "quantity"))
    # Grouping combines on the map side; a window would move every duplicate.
    others = [c for c in ticks.columns if c not in ("symbol", "id")]
    first = F.min(F.struct(*others)).alias("row")
    return ticks.groupBy("symbol", "id", key.alias("alike")).agg(first).select("symbol", "id", *[f"row.{c}" for c in others]).select(ticks.columns)


def normalise(ticks: DataFrame, policy: str = "exact") -> DataFrame:
    kept = deduplicate(ticks.where(is_sane()), policy)
    dollar = F.col("dollar") if "dollar" in ticks.columns else F.lit(None).cast("double")
    return kept.withColumn("dollar", F.coalesce(dollar, F.col("price") * F.col("quantity")))


#: Rows of a rolling window's matrix, values in all, that a median looks at at once.
_MEDIAN_CELLS = 4_000_000
#: Seconds of a time bucket where a scope is cut into pieces.
PIECE_SECONDS = 600


def _rolling_median(x: np.ndarray, width: int) -> np.ndarray:
    """Medians of the ``width`` values up to each, from the first full window on; nan where one of them is."""
    n = len(x) - width + 1
    if n <= 0:
        return np.empty(0)
    windows = np.lib.stride_tricks.sliding_window_view(x, width)
    out, step = np.empty(n), max(1, _MEDIAN_CELLS // width)
    for at in range(0, n, step):
        out[at : at + step] = np.median(windows[at : at + step], axis=1)
    return out


class _Deviations:
    """Deviation from the rolling median and its own rolling median, batch by batch, over one piece of a scope."""

    def __init__(self, width: int, mad: float | None):
        self.width, self.mad = width, np.nan if mad is None else mad
        self.prices, self.devs = np.empty(0), np.empty(0)  # what the next window still reaches

    def feed(self, price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(dev, mad)`` of each price: nan until the windows are full; a zero deviation takes the last positive one."""
        back, w = len(price), self.width
        tail = lambda x: x[-(w - 1) :] if w > 1 else x[:0]
        full = lambda x: np.concatenate([np.full(back - min(back, len(x)), np.nan), x[max(0, len(x) - back) :]])
        prices = np.concatenate([self.prices, price])
        med = full(_rolling_median(prices, w))
        dev = np.abs(price - med)
        devs = np.concatenate([self.devs, dev])
        raw = full(_rolling_median(devs, w))
        self.prices, self.devs = tail(prices), tail(devs)
        raw = np.where(raw == 0, np.nan, raw)
        at = np.maximum.accumulate(np.where(np.isnan(raw), -1, np.arange(back)))
        mad = np.where(at >= 0, raw[at], self.mad)
        self.mad = mad[-1] if back else self.mad
        return dev, mad


def _mad_folded(rows: DataFrame, scope: list[str], width: int) -> DataFrame:
    """``rows`` with ``_piece, _role`` (0 a value carried in, 1 a halo row, 2 a row) and ``_mad_in``: the rows themselves with ``_dev`` and ``mad``."""
    keys = [*scope, "_piece"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "_role", *ORDER)
    names = dealt.columns
    spots = [names.index(c) for c in keys]
    price_at, role_at, in_at = names.index("price"), names.index("_role"), names.index("_mad_in")

    def run(batches):
        own, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            owners = list(zip(*(batch.column(i).to_pylist() for i in spots), strict=True))
            cuts = [0, *[i for i in range(1, len(owners)) if owners[i] != owners[i - 1]], len(owners)]
            price = np.array(batch.column(price_at).cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float)
            role = batch.column(role_at).to_numpy(zero_copy_only=False)
            dev, mad = np.full(len(price), np.nan), np.full(len(price), np.nan)
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if owners[lo] != own:
                    own, held = owners[lo], _Deviations(width, batch.column(in_at)[lo].as_py())
                while lo < hi and role[lo] == 0:
                    lo += 1
                # Halo rows fill the windows; the value carried in already stands for their deviations.
                mid = lo + int((role[lo:hi] == 1).sum())
                if mid > lo:
                    before = held.mad
                    held.feed(price[lo:mid])
                    held.mad = before
                if hi > mid:
                    dev[mid:hi], mad[mid:hi] = held.feed(price[mid:hi])
            kept = pa.array(role == 2)
            columns = [batch.column(i).filter(kept) for i in range(batch.num_columns)]
            both = [pa.array(x[role == 2], from_pandas=True) for x in (dev, mad)]
            yield pa.RecordBatch.from_arrays([*columns, *both], names=[*names, "_dev", "mad"])

    schema = T.StructType([*dealt.schema.fields, T.StructField("_dev", T.DoubleType()), T.StructField("mad", T.DoubleType())])
    return dealt.mapInArrow(run, schema)


def mad_scores(ticks: DataFrame, scope: list[str], width: int = 100, piece_rows: int | None = None) -> DataFrame:
    """Adds ``mad_z``: robust z-score of the price in the causal window that ends in the row.

    Null until the window is full; a zero deviation takes the last positive
    one.  With ``piece_rows`` a scope is cut into pieces of about so many rows
    (at least the halo of ``2 * width - 2``), which are scored in parallel with
    the same result; a first pass over the prices finds what each piece starts
    from.  Rows with a null key or time go then.
    """
    blank = {"_mad_in": F.lit(None).cast("double")}
    if piece_rows is None:
        folded = _mad_folded(ticks.withColumns({"_piece": F.lit(0).cast("long"), "_role": F.lit(2)} | blank), scope, width)
    else:
        halo = 2 * width - 2
        table = pieces.cut_keys(ticks.where("ts is not null").dropna(subset=scope), scope, ORDER[0], max(piece_rows, halo, 1), PIECE_SECONDS)
        rows = pieces.in_pieces(ticks, table, scope, ORDER[0], PIECE_SECONDS).withColumns({"_role": F.lit(2)} | blank)

        def with_halo(rows: DataFrame) -> DataFrame:
            return rows.unionByName(pieces.last_rows(rows, [*scope], ORDER, halo).withColumn("_role", F.lit(1))) if halo else rows

        alone = _mad_folded(with_halo(rows.select(*scope, *ORDER, "price", "_piece", "_role", "_mad_in")), scope, width)
        ends = alone.where("mad is not null").groupBy(*scope, "_piece").agg(F.max_by("mad", F.struct(*ORDER)).alias("_mad_in"))
        heads = pieces.carried_in(ends, table, scope, "_mad_in").withColumn("_role", F.lit(0))
        folded = _mad_folded(with_halo(rows).unionByName(heads, allowMissingColumns=True), scope, width)
    return folded.withColumn("mad_z", 0.6745 * F.col("_dev") / F.col("mad")).drop("_piece", "_role", "_mad_in", "_dev", "mad")


def mad_filter(ticks: DataFrame, scope: list[str], width: int = 100, k: float = 10.0, piece_rows: int | None = None) -> DataFrame:
    """Drops ticks whose score exceeds ``k``; rows without a score stay."""
    return mad_scores(ticks, scope, width, piece_rows).where(F.coalesce("mad_z", F.lit(0.0)) <= k).drop("mad_z")


def direction_by_rule(scope: list[str]) -> Column:
    """Sign of the price change, carried over unchanged prices; +1 before any change."""
    running = Window.partitionBy(*scope).orderBy(*ORDER)
    move = F.signum(F.col("price") - F.lag("price").over(running))
    return move


def with_direction(ticks: DataFrame, scope: list[str], mode: str = "tick_rule") -> DataFrame:
    if mode == "aggressor" and "is_buyer_maker" in ticks.columns:
        return ticks.withColumn("b", F.when(F.col("is_buyer_maker"), -1).otherwise(1))
    if mode not in ("tick_rule", "aggressor"):
        raise ValueError(f"unknown direction mode: {mode}")
    running = Window.partitionBy(*scope).orderBy(*ORDER)
    moved = ticks.withColumn("move", F.nullif(direction_by_rule(scope), F.lit(0.0)))
    return moved.withColumn("b", F.coalesce(F.last("move", ignorenulls=True).over(running), F.lit(1.0)).cast("int")).drop("move")


def audit(ticks: DataFrame, scope: list[str], width: int = 100, k: float = 10.0) -> DataFrame:
    """Counters per scope: received = invalid + duplicates + mad_removed + clean."""
    counts = ticks.groupBy(*scope).agg(F.count("*").alias("received"), F.count_if(~is_sane()).alias("invalid"))
    unique = deduplicate(ticks.where(is_sane()))
    scored = mad_scores(unique, scope, width).withColumn("out", F.coalesce("mad_z", F.lit(0.0)) > k)
    kept = scored.groupBy(*scope).agg(F.count("*").alias("unique"), F.count_if("out").alias("mad_removed"))
    both = counts.join(kept, scope, "left").na.fill(0, ["unique", "mad_removed"])
    return both.select(
        *scope, "received", "invalid", (F.col("received") - F.col("invalid") - F.col("unique")).alias("duplicates"), "mad_removed",
        (F.col("unique") - F.col("mad_removed")).alias("clean"),
    )


def fill_missing(bars: DataFrame, scope: list[str], order: list[str]) -> DataFrame:
    """Prices are carried forward, activity becomes 0, rows that still miss something go."""
    running = Window.partitionBy(*scope).orderBy(*order)
    out = bars
    for c in ("open", "high", "low", "close", "vwap"):
        if c in bars.columns:
            out = out.withColumn(c, F.last(c, ignorenulls=True).over(running))
    zero = [c for c in ("volume", "dollar", "n_ticks", "buy_volume", "sell_volume") if c in bars.columns]
    return out.na.fill(0, zero).na.drop()


def log_price(price: Column) -> Column:
    return F.when(price > 0, F.ln(price))
