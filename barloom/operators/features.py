"""Causal features of bars, all over one window per symbol, so that one sort serves them.

Rolling values are null until their window is full.  ``ma="sma"`` or ``"ewm"``
chooses the moving average where indicator libraries differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, ORDER = ["symbol"], ["open_time", "close_time"]
BAR_FEATURES = [
    "log_return", "frac_diff_return", "rolling_volatility", "bar_range", "atr_pct", "volume_z", "dollar_value_z", "n_ticks_z",
    "vwap", "price_to_vwap", "bar_duration_secs", "rsi", "bb_pct_b", "macd_hist",
]
#: Rows after which an exponential average has forgotten its start to double precision.
EWM_ROWS = 260


def whole() -> Window:
    return Window.partitionBy(*KEY).orderBy(*ORDER)


def rows(n: int):
    return whole().rowsBetween(1 - n, 0)


def _full(x: Column, n: int, value: Column) -> Column:
    return F.when(F.count(x).over(rows(n)) == n, value)


def rolling_mean(x: Column, n: int) -> Column:
    return _full(x, n, F.avg(x).over(rows(n)))


def ewm(x: Column, span: int, n: int) -> Column:
    """Exponential mean without adjustment, started at the first value, null before ``n`` values."""
    alpha = 2.0 / (span + 1)
    values = F.collect_list(x).over(rows(EWM_ROWS))
    folded = F.aggregate(F.slice(values, 2, EWM_ROWS), F.element_at(values, 1), lambda acc, v: acc * (1 - alpha) + v * alpha)
    return F.when(F.count(x).over(rows(n)) == n, folded)


def average(x: Column, n: int, ma: str) -> Column:
    return ewm(x, n, n) if ma == "ewm" else rolling_mean(x, n)


def z_score(x: Column, n: int = 20) -> Column:
    return _full(x, n, (x - F.avg(x).over(rows(n))) / F.nullif(F.stddev_samp(x).over(rows(n)), F.lit(0.0)))


def frac_diff_weights(d: float = 0.4, threshold: float = 1e-4, limit: int = 10_000) -> list[float]:
    weights = [1.0]
    while len(weights) < limit:
        k = len(weights)
        w = -weights[-1] * (d - k + 1) / k
        if abs(w) < threshold:
            break
        weights.append(w)
    return weights


def frac_diff(price: Column, d: float = 0.4, threshold: float = 1e-4) -> Column:
    """Fractionally differenced log price with a filter of fixed length."""
    weights = frac_diff_weights(d, threshold)
    n = len(weights)
    values = F.collect_list(F.ln(price)).over(rows(n))
    newest_last = F.array(*[F.lit(w) for w in reversed(weights)])
    dot = F.aggregate(F.zip_with(values, newest_last, lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(values) == n, dot)


def log_return() -> Column:
    return F.ln(F.col("close") / F.lag("close").over(whole()))


def with_returns(bars: DataFrame, d: float = 0.4) -> DataFrame:
    return bars.withColumn("log_return", log_return()).withColumn("frac_diff_return", frac_diff(F.col("close"), d))


def with_volatility(bars: DataFrame, ma: str = "ewm") -> DataFrame:
    """Needs ``log_return``."""
    previous = F.lag("close").over(whole())
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - previous), F.abs(F.col("low") - previous))
    out = bars.withColumn("rolling_volatility", F.sqrt(rolling_mean(F.col("log_return") * F.col("log_return"), 20)))
    out = out.withColumn("bar_range", (F.col("high") - F.col("low")) / F.nullif(F.col("close"), F.lit(0.0))).withColumn("_tr", true_range)
    return out.withColumn("atr_pct", average(F.col("_tr"), 14, ma) / F.nullif(F.col("close"), F.lit(0.0))).drop("_tr")


def with_activity(bars: DataFrame) -> DataFrame:
    return bars.select(
        "*", z_score(F.col("volume")).alias("volume_z"), z_score(F.col("dollar")).alias("dollar_value_z"),
        z_score(F.col("n_ticks").cast("double")).alias("n_ticks_z"),
    )


def with_structure(bars: DataFrame, ma: str = "sma") -> DataFrame:
    change = F.col("close") - F.lag("close").over(whole())
    out = bars.withColumn("vwap", F.col("dollar") / F.nullif(F.col("volume"), F.lit(0.0)))
    out = out.withColumn("price_to_vwap", F.col("close") / F.nullif(F.col("vwap"), F.lit(0.0)) - 1)
    out = out.withColumn("bar_duration_secs", (F.unix_micros(F.col("close_time").cast("timestamp")) - F.unix_micros(F.col("open_time").cast("timestamp"))) / 1e6)
    out = out.withColumn("_chg", change)
    up, down = average(F.greatest(F.col("_chg"), F.lit(0.0)), 14, ma), average(F.greatest(-F.col("_chg"), F.lit(0.0)), 14, ma)
    out = out.withColumn("_up", F.when(F.col("_chg").isNotNull(), up)).withColumn("_down", F.when(F.col("_chg").isNotNull(), down))
    # The first change is null, so full windows of changes start one row later.
    enough = F.count("_chg").over(rows(14)) == 14
    rsi = F.when(F.col("_down") == 0, F.when(F.col("_up") > 0, F.lit(100.0))).otherwise(100 - 100 / (1 + F.col("_up") / F.nullif(F.col("_down"), F.lit(0.0))))
    out = out.withColumn("rsi", F.when(enough, rsi))
    mid, dev = rolling_mean(F.col("close"), 20), F.stddev_pop("close").over(rows(20))
    out = out.withColumn("bb_pct_b", (F.col("close") - (mid - 2 * dev)) / F.nullif(4 * dev, F.lit(0.0)))
    out = out.withColumn("_macd", average(F.col("close"), 12, ma) - average(F.col("close"), 26, ma))
    out = out.withColumn("macd_hist", F.col("_macd") - average(F.col("_macd"), 9, ma))
    return out.drop("_chg", "_up", "_down", "_macd")


def funding_mean(funding: DataFrame, n: int = 3) -> DataFrame:
    w = Window.partitionBy("symbol").orderBy("funding_time").rowsBetween(1 - n, 0)
    return funding.withColumn("funding_rate_mean", F.avg("funding_rate").over(w))


def bar_features(bars: DataFrame, atr: str = "ewm", ma: str = "sma") -> DataFrame:
    return with_structure(with_activity(with_volatility(with_returns(bars), atr)), ma)


def compute_features(bars: DataFrame, funding: DataFrame | None = None, winsorize: list[str] | None = None, required: list[str] | None = None) -> DataFrame:
    """All features; rows that miss a ``required`` one (by default any bar feature) go, funding may stay null."""
    from barloom.operators import joins, winsor

    out = bar_features(bars)
    if funding is not None:
        rates = funding_mean(funding).select("symbol", "funding_time", "funding_rate_mean").where("funding_rate_mean is not null")
        out = joins.asof_backward(out, rates, "open_time", "funding_time", ["symbol"], ["funding_rate_mean"])
    if winsorize:
        out = winsor.clip_global(out, winsorize)
    required = BAR_FEATURES if required is None else required
    return out.na.drop(subset=required) if required else out


def drawdown(returns: DataFrame, scope: list[str], order: list[str], column: str = "log_return") -> DataFrame:
    """Running product of ``1 + r``, its running maximum and the relative gap."""
    running = Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = returns.withColumn("equity", F.exp(F.sum(F.ln(1 + F.col(column))).over(running)))
    out = out.withColumn("peak", F.max("equity").over(running))
    return out.withColumn("drawdown", F.col("equity") / F.col("peak") - 1)


def missing_ranges(days: DataFrame, first: str, last: str) -> DataFrame:
    """Contiguous ranges of days without a row, per symbol (gaps and islands)."""
    calendar = days.select("symbol").distinct().select("symbol", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    gone = calendar.join(days.select("symbol", "day").distinct(), ["symbol", "day"], "left_anti")
    island = F.date_sub("day", F.row_number().over(Window.partitionBy("symbol").orderBy("day")))
    return gone.withColumn("island", island).groupBy("symbol", "island").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")).drop("island")


def latest(rows_: DataFrame, key: list[str], order: list, n: int = 1) -> DataFrame:
    """The last ``n`` rows of each key under ``order`` (descending columns)."""
    return rows_.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")
