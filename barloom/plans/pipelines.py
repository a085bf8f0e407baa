"""Compositions: yearly build, daily inference with fallbacks, incremental append.

Symbols are partition keys, never loops; a run over all symbols is one job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import bars, features, joins, quality, ticks, winsor
from barloom.sources import sinks

#: Parameters of symbols without a study, and T where it differs.
DEFAULTS = {"exp_lambda": 0.9975, "init_exp_t": 2000.0}
DEFAULT_T = {"BTCUSDT": 14738.0, "ETHUSDT": 5000.0, "BNBUSDT": 500.0, "SOLUSDT": 2000.0}
#: Columns that the causal winsorizer clips.
CLIPPED = ["log_return", "frac_diff_return", "volume_z", "dollar_value_z", "n_ticks_z", "price_to_vwap"]


def symbol_defaults() -> dict[str, Column]:
    """``DEFAULTS`` as columns over ``symbol``."""
    t = F.lit(DEFAULTS["init_exp_t"])
    for symbol, value in DEFAULT_T.items():
        t = F.when(F.col("symbol") == symbol, F.lit(value)).otherwise(t)
    return {"exp_lambda": F.lit(DEFAULTS["exp_lambda"]), "init_exp_t": t}


def clean_ticks(raw: DataFrame, width: int = 100, k: float = 10.0) -> DataFrame:
    """Normalised ticks without outliers; the filter's window stays within a symbol's day, which bounds it."""
    rows = ticks.normalise(raw).withColumn("day", F.to_date("ts"))
    return ticks.mad_filter(rows, ["symbol", "day"], width, k)


def daily_bars(clean: DataFrame, studies: DataFrame, min_ticks: int = 400, defaults: dict | None = None) -> DataFrame:
    """Run bars of each symbol's day with the parameters of the latest study before its month."""
    defaults = defaults or symbol_defaults()
    days = clean.select("symbol", F.to_date("ts").alias("day")).distinct().withColumn("period", F.date_format("day", "yyyy-MM"))
    params = joins.param_lookup(days, studies, defaults).drop("period").withColumnRenamed("source", "study_source")
    one = F.array(F.struct(F.lit(0).alias("param_id"), "exp_lambda", "init_exp_t"))
    made = bars.candidate_bars(clean.withColumn("day", F.to_date("ts")), ["symbol", "day"], params.select("symbol", "day", one.alias("candidates")), min_ticks).drop("param_id")
    return made.join(params.select("symbol", "day", "study_source"), ["symbol", "day"])


def training_frame(raw: DataFrame, funding: DataFrame, studies: DataFrame, min_ticks: int = 400, fail_below: int = 40, recovered: DataFrame | None = None, defaults: dict | None = None) -> DataFrame:
    """Ticks to the training rows: bars, causal features, prior-period winsorizing, day labels and weights."""
    made = daily_bars(clean_ticks(raw), studies, min_ticks, defaults)
    per_day = made.groupBy("symbol", "day").agg(F.count("*").alias("n"))
    failed = per_day.where(F.col("n") < fail_below)
    made = made.withColumn("recovered_day", F.lit(False))
    if recovered is not None:
        made = bars.merge_recovered(made, recovered.withColumn("recovered_day", F.lit(True)))
    rows = features.compute_features(made, funding)
    rows = winsor.clip_accumulating(rows.withColumn("month", F.date_format("day", "yyyy-MM")), CLIPPED, "month")
    rows = quality.mark_failed_days(rows, failed)
    return rows.withColumn("recovery_status", quality.recovery_status(F.col("recovered_day"), F.col("failed_day") == 1))


def build_year(frame: DataFrame, path: str, year: int, checked: list[str]) -> None:
    """Validates and publishes one year; the old files stay when a gate fails."""

    def errors(df: DataFrame) -> list[str]:
        verdict = quality.validate_frame(df, checked, year).where("not valid")
        return [f"{r.symbol}: {e}" for r in verdict.collect() for e in r.errors]  # a row a symbol

    sinks.publish(frame.where(F.year("open_time") == year), path, errors, ["symbol"])


def fallback_day(clean_day: DataFrame, levels: list[tuple[float, float]], min_ticks: int, min_bars: int = 40) -> DataFrame:
    """Bars of a day at the first parameter level that gives enough of them, else one bar of the whole day.

    All levels are folded side by side and one is kept; ``level`` says which.
    """
    made = bars.candidate_bars(clean_day.withColumn("day", F.to_date("ts")), ["symbol", "day"], [(i, lam, float(t)) for i, (lam, t) in enumerate(levels)], min_ticks)
    made = made.drop("exp_lambda", "init_exp_t").withColumnRenamed("param_id", "level")
    whole = bars.day_bars(clean_day).withColumns({"level": F.lit(len(levels)), "bar_id": F.lit(0).cast("long")})
    every = made.unionByName(whole.select(made.columns))
    counts = every.groupBy("symbol", "day", "level").agg(F.count("*").alias("bars"))
    return every.join(quality.fallback_choice(counts, min_bars).select("symbol", "day", "level"), ["symbol", "day", "level"])


def process_day(clean_day: DataFrame, context: DataFrame, levels: list[tuple[float, float]], min_ticks: int, keep: int = 300, min_bars: int = 40) -> DataFrame:
    """New bars with features computed after the context bars, clipped at the context's bounds, merged and rotated.

    ``context`` holds earlier bars with ``day``; rows still in warm-up keep null features.
    """
    new = fallback_day(clean_day, levels, min_ticks, min_bars)
    shared = ["symbol", "day", *[c.strip() for c in bars.BAR.split(",")]]
    both = context.select(shared).withColumn("is_context", F.lit(True)).unionByName(new.select(shared).withColumn("is_context", F.lit(False)))
    rows = features.bar_features(both)
    fresh = winsor.fit_on_context(rows, CLIPPED, F.col("is_context")).drop("is_context")
    old = rows.where("is_context").drop("is_context")
    return sinks.replace_and_rotate(old, fresh, keep)


def append_days(frame: DataFrame, path: str) -> None:
    """Adds the days a store lacks; a second run adds nothing."""
    sinks.append_missing_days(frame, path)


def missing_days(stored: DataFrame, first: str, last: str) -> DataFrame:
    return features.missing_ranges(stored, first, last)


def run_checked(frame: DataFrame, gate: Callable[[DataFrame], DataFrame], report_path: str) -> DataFrame:
    """Writes the report first, then raises when the gate has errors."""
    report = gate(frame)
    report.write.mode("overwrite").parquet(report_path)
    bad = frame.sparkSession.read.parquet(report_path).where(F.size("errors") > 0)
    if not bad.isEmpty():
        raise ValueError(f"gate failed: {[r.asDict() for r in bad.limit(5).collect()]}")
    return frame


def latest_context(stored: DataFrame, before: str, n: int = 300) -> DataFrame:
    """The last ``n`` bars of each symbol before a day; the first bar where there is none before."""
    earlier: Column = F.col("day") < F.lit(before).cast("date")
    w = Window.partitionBy("symbol").orderBy(F.desc(earlier), F.when(earlier, -F.unix_micros(F.col("open_time").cast("timestamp"))).otherwise(F.unix_micros(F.col("open_time").cast("timestamp"))))
    ranked = stored.withColumns({"_r": F.row_number().over(w), "_e": earlier})
    has = F.max("_e").over(Window.partitionBy("symbol"))
    return ranked.withColumn("_has", has).where((F.col("_e") & (F.col("_r") <= n)) | (~F.col("_has") & (F.col("_r") == 1))).drop("_r", "_e", "_has")
