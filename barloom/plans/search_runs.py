"""Searches that run in rounds, with their state in written tables: successive halving, and a year of chained windows.

Rounds are few and each is one job over all symbols.  A round that is written
whole is never run again, so a search that was stopped goes on where it was.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import search, trials
from barloom.sources import sinks

CANDIDATE = ["param_id", "exp_lambda", "init_exp_t"]


def _written(frame, path: str) -> DataFrame:
    """``path``, from ``frame()`` only if no earlier run has finished it."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    if not sinks.exists(spark, f"{path}/_SUCCESS"):
        frame().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sampled_rounds(days: DataFrame, shares: list[float], seed: int) -> DataFrame:
    """``(symbol, day, round)``: the round in which a day joins a sample that grows by ``shares`` of the symbol's days."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("day").cast("string")))
    ranked = days.withColumns({"_r": F.row_number().over(Window.partitionBy("symbol").orderBy(key, "day")), "_n": F.count("*").over(Window.partitionBy("symbol"))})
    out = F.lit(None).cast("int")
    for i, share in reversed(list(enumerate(shares))):
        out = F.when(F.col("_r") <= F.ceil(F.col("_n") * F.lit(float(share))), i).otherwise(out)
    return ranked.select("symbol", "day", out.alias("round")).where("round is not null")


def standing(folded: DataFrame, least_bars: int, floor: float = 0.6) -> DataFrame:
    """Scores so far of the candidates that took part in the last round of ``folded``."""
    last = folded.groupBy("symbol").agg(F.max("round").alias("_last"))  # a row a symbol
    alive = folded.join(F.broadcast(last), "symbol").where(F.col("round") == F.col("_last")).select("symbol", "param_id").distinct()
    rows = folded.join(alive, ["symbol", "param_id"], "left_semi").withColumnRenamed("quality_score", "quality")
    return search.composite_score(rows, ["symbol", *CANDIDATE], least_bars, math.inf, floor)


def survivors(folded: DataFrame, least_bars: int) -> DataFrame:
    """``(symbol, candidates)``: of the last round's candidates those at or above the median score of their symbol."""
    scored = standing(folded, least_bars)
    kept = scored.withColumn("_m", F.percentile("score", F.lit(0.5)).over(Window.partitionBy("symbol"))).where(F.col("score") >= F.col("_m"))
    return kept.groupBy("symbol").agg(F.array_sort(F.collect_list(F.struct(*CANDIDATE))).alias("candidates"))


def halving_search(
    ticks: DataFrame, candidates: DataFrame, path: str, shares: tuple[float, ...] = (0.1, 0.3, 1.0), min_ticks: int = 400, least_bars: int = 50, seed: int = 7
) -> DataFrame:
    """The ranking of the candidates that the last round still had: ``symbol``, the candidate, its scores, ``rank``.

    ``ticks`` with ``day``; ``candidates``: ``symbol, candidates``.  Round r
    folds the surviving candidates over the days that its share of the sample
    adds; between rounds those below the median of their symbol go.  The state,
    ``path/round=r``, has a row for each candidate and day that was folded.
    """
    days = _written(lambda: sampled_rounds(ticks.select("symbol", "day").distinct(), list(shares), seed), f"{path}/days")
    alive, folded = candidates, None
    for r in range(len(shares)):

        def one(r: int = r, alive: DataFrame = alive) -> DataFrame:
            own = days.where(F.col("round") == r).select("symbol", "day")
            lists = own.join(alive, "symbol").select("symbol", "day", "candidates")
            return trials.score_candidates(ticks.join(own, ["symbol", "day"], "left_semi"), ["symbol", "day"], lists, min_ticks)

        made = _written(one, f"{path}/round={r}").withColumn("round", F.lit(r))
        folded = made if folded is None else folded.unionByName(made)
        if r + 1 < len(shares):
            alive = survivors(folded, least_bars)
    scored = standing(folded, least_bars)
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("score"), "param_id")))


def year_search(
    ticks: DataFrame, windows: list[tuple[str, str, str]], bounds: DataFrame, path: str, n: int = 100, min_ticks: int = 400, least_bars: int = 50, floor: float = 0.6
) -> DataFrame:
    """Trials of consecutive windows ``(name, first day, day after the last)``: ``window, symbol``, the candidate, its scores and the bounds it was drawn from.

    ``ticks`` with ``day``; ``bounds``: ``symbol`` and ``search.BOUNDS`` of the
    first window.  Every later window searches the bounds that the trials of
    the one before give.  ``path/window=name`` is a window's result; those that
    are there are not searched again.  A symbol without ticks in a window keeps
    its bounds and has one row there, without a candidate.
    """
    now, out = bounds.select("symbol", *search.BOUNDS), None
    for name, first, after in windows:

        def one(first: str = first, after: str = after, now: DataFrame = now) -> DataFrame:
            own = ticks.where((F.col("day") >= F.lit(first).cast("date")) & (F.col("day") < F.lit(after).cast("date")))
            lists = own.select("symbol", "day").distinct().join(trials.spread_candidates(now, ["symbol"], n, log_t=True), "symbol").select("symbol", "day", "candidates")
            days = trials.score_candidates(own, ["symbol", "day"], lists, min_ticks).withColumnRenamed("quality_score", "quality")
            scored = search.composite_score(days, ["symbol", *CANDIDATE], least_bars, math.inf, floor)
            return now.join(scored, "symbol", "left")

        found = _written(one, f"{path}/window={name}").withColumn("window", F.lit(name))
        tried = found.where("param_id is not null").select("symbol", F.col("param_id").alias("trial"), "score", "init_exp_t", "exp_lambda")
        now = search.adaptive_bounds(tried, found.select("symbol", *search.BOUNDS).distinct()).select("symbol", *search.BOUNDS)
        out = found if out is None else out.unionByName(found)
    return out
