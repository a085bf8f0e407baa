"""Studies of the parameter search: aggregation over days, diagnostics, one day's search, and what a viewer shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import trials

#: Least share of successes, share of days then demanded, name of the level.
LEVELS = [(0.80, 1.00, "EXCELLENT"), (0.60, 0.90, "GOOD"), (0.40, 0.85, "FAIR"), (0.00, 0.80, "POOR")]
#: The candidates that a diagnostic tries.
DIAGNOSTIC_GRID = [(0.99, 1000.0), (0.99, 2500.0), (0.95, 1000.0), (0.95, 2500.0), (0.975, 1500.0)]


def aggregate_grid(results: DataFrame, expected_days: int) -> DataFrame:
    """A candidate's days as one row: ``(symbol, exp_lambda, init_exp_t, day, quality_score, bars, abs_acf_lag1, cv_ticks, is_stationary, std_return, sharpe_ratio)``.

    Deviations are those of a sample, null for one day.  Null scores do not
    count as days; completion is the share of ``expected_days`` that have one.
    """
    out = results.groupBy("symbol", "exp_lambda", "init_exp_t").agg(
        F.avg("quality_score").alias("quality_score_mean"), F.stddev_samp("quality_score").alias("quality_score_std"), F.count("quality_score").alias("n_days"),
        *[F.avg(c).alias(c) for c in ("abs_acf_lag1", "cv_ticks", "std_return", "sharpe_ratio")],
        F.avg("bars").alias("n_bars_mean"), F.stddev_samp("bars").alias("n_bars_std"),
        (F.count_if("is_stationary") / F.count("*")).alias("stationary_ratio"),
    )
    return out.withColumn("completion_rate", F.col("n_days") / F.lit(expected_days))


def _level(rate: Column, which: int) -> Column:
    out = F.lit(LEVELS[-1][which])
    for level in reversed(LEVELS[:-1]):
        out = F.when(rate >= level[0], F.lit(level[which])).otherwise(out)
    return out


def diagnose(tests: DataFrame, by: list[str]) -> DataFrame:
    """How good a period is, from trials of a few candidates on a sample of its days: ``(by, day, succeeded)``.

    Three distinct days or more with a failure lower a demand of 0.9 and above
    by 15 %, to 0.8 at least.  A null outcome is a failure.
    """
    won = F.coalesce("succeeded", F.lit(False))
    out = tests.groupBy(*by).agg(
        F.count("*").alias("tests"), F.count_if(won).alias("successes"), F.count_distinct("day").alias("days"),
        F.count_distinct(F.when(~won, F.col("day"))).alias("failed_days"),
    )
    rate = F.col("successes") / F.col("tests")
    out = out.withColumns({"success_rate": rate, "assessment": _level(rate, 2), "demand": _level(rate, 1), "failed_day_ratio": F.col("failed_days") / F.col("days")})
    strict = (F.col("failed_days") >= 3) & (F.col("demand") >= 0.90)
    return out.withColumn("demand", F.when(strict, F.greatest(F.lit(0.80), F.col("demand") * 0.85)).otherwise(F.col("demand")))


def diagnostic_tests(ticks: DataFrame, scope: list[str], min_ticks: int, enough: int = 50, grid: list[tuple[int, float, float]] | None = None, lags: int | None = 5) -> DataFrame:
    """Trials of the diagnostic's candidates on every scope's ticks; they succeed with ``enough`` bars."""
    grid = [(i, lam, t) for i, (lam, t) in enumerate(DIAGNOSTIC_GRID)] if grid is None else grid
    return trials.score_candidates(ticks, scope, grid, min_ticks, lags=lags).withColumn("succeeded", F.col("bars") >= enough)


def overview(trials: DataFrame, by: list[str], maximise: bool = True) -> DataFrame:
    """Trials by state and the best complete one of each study: ``(by, trial, state, value)``; of equals the first."""
    done = (F.col("state") == "COMPLETE") & F.col("value").isNotNull()
    order = F.struct((F.col("value") if maximise else -F.col("value")).alias("v"), (-F.col("trial")).alias("t"))
    best = F.max_by(F.struct("trial", "value"), F.when(done, order))
    states = [F.count_if(F.col("state") == s).alias(s.lower()) for s in ("COMPLETE", "FAIL", "PRUNED")]
    out = trials.groupBy(*by).agg(F.count("*").alias("trials"), *states, best.alias("best"))
    return out.select(*by, "trials", "complete", "fail", "pruned", F.col("best.trial").alias("best_trial"), F.col("best.value").alias("best_value"))


def top_trials(trials: DataFrame, by: list[str], n: int = 10, maximise: bool = True) -> DataFrame:
    """The ``n`` best trials of each study with their rank; trials without a value come last, equals by number."""
    order = F.desc_nulls_last("value") if maximise else F.asc_nulls_last("value")
    return trials.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(order, "trial"))).where(F.col("rank") <= n)
