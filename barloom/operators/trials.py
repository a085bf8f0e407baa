"""Trials of bar parameters: candidates are folded and scored side by side over ticks that are shuffled once.

A scope (a symbol's day, say) carries its candidates as one row in front of its
ticks; the fold runs all of them over the same batch and returns a row for each
with the measures of its bars, so neither ticks nor bars are multiplied in a
shuffle.  Searches differ in where candidates come from, when they stop, and
how the rows of days become a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import stats
from barloom.operators import bars, joins

#: The T a search of one day starts from, by symbol.
DEFAULT_T = {"BTCUSDT": 14738.0, "ETHUSDT": 5000.0, "BNBUSDT": 500.0, "SOLUSDT": 2000.0}
OTHER_T = 5000.0
#: Steps of the R2 sequence: points of a square that stay evenly spread, however many are taken.
STEP_T, STEP_LAMBDA = 0.7548776662466927, 0.5698402909980532

MEASURES = "bars long, mean_ticks double, quality_score double, abs_acf_lag1 double, cv_ticks double, is_stationary boolean, std_return double, sharpe_ratio double"


def points(n: int) -> list[tuple[int, float, float]]:
    """``(param_id, share of the range of T, share of the range of lambda)``, the same ones in every run."""
    return [(i, (0.5 + i * STEP_T) % 1, (0.5 + i * STEP_LAMBDA) % 1) for i in range(n)]


def spread_candidates(bounds: DataFrame, by: list[str], n: int, log_t: bool = False) -> DataFrame:
    """``(by, candidates)``: ``n`` candidates inside each row's ``t_min, t_max, lambda_min, lambda_max``; T is whole."""
    lo, hi = F.col("t_min").cast("double"), F.col("t_max").cast("double")
    width = F.col("lambda_max") - F.col("lambda_min")

    def one(i: int, u: float, v: float) -> Column:
        t = F.floor(lo * F.pow((hi + 1) / lo, F.lit(u))) if log_t else F.floor(lo + u * (hi - lo + 1))
        return F.struct(
            F.lit(i).alias("param_id"), F.round(F.col("lambda_min") + v * width, 6).alias("exp_lambda"), F.least(t.cast("double"), hi).alias("init_exp_t")
        )

    return bounds.select(*by, F.array(*[one(*p) for p in points(n)]).alias("candidates"))


def measures(close: np.ndarray, n_ticks: np.ndarray, lags: int | None = 5) -> tuple:
    """``MEASURES`` of one candidate's bars in order; null where there are too few.  ``lags``: of the unit-root test, None by AIC."""
    if not len(close):
        return (0, *[None] * 7)
    returns = np.diff(np.log(close))
    known = lambda x: float(x) if np.isfinite(x) else None
    acf = spread = sharpe = stationary = None
    if len(returns) >= 3 and returns[1:].std() > 0 and returns[:-1].std() > 0:
        acf = known(abs(np.corrcoef(returns[1:], returns[:-1])[0, 1]))
    if len(returns) >= 2:
        spread = known(returns.std(ddof=1))
        sharpe = known(returns.mean() / returns.std(ddof=1) * 252**0.5) if spread else 0.0
    if len(returns) >= 14:
        stat = stats.adf_statistic(returns, lags)[0] if lags is not None else stats.adf_best_lag(returns)[0]
        stationary = bool(stats.adf_p_value(stat) < 0.05) if np.isfinite(stat) else None
    return (len(close), float(n_ticks.mean()), stats.quality_score(returns, n_ticks.astype(float)), acf, float(n_ticks.std() / n_ticks.mean()), stationary, spread, sharpe)


def score_candidates(
    ticks: DataFrame, scope: list[str], candidates: DataFrame | list[tuple[int, float, float]], min_ticks: int = 400,
    least_ticks: int = 0, stop_at: int | None = None, lags: int | None = 5,
) -> DataFrame:
    """One row per scope and candidate: ``scope, param_id, exp_lambda, init_exp_t`` and ``MEASURES``.

    ``candidates`` as in ``bars.candidate_bars``.  Scopes of fewer than
    ``least_ticks`` ticks have no rows.  With ``stop_at`` candidates count as
    tried in order: once one has so many bars, later ones are given up in the
    middle of the fold and have no row.
    """
    per_scope = isinstance(candidates, DataFrame)
    shared = [] if per_scope else candidates
    kinds = dict(ticks.dtypes)
    names = [*scope, "param_id", "exp_lambda", "init_exp_t", *[c.split()[0] for c in MEASURES.split(", ")]]
    numeric = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    arrow = [pa.int32(), pa.float64(), pa.float64(), *[numeric[c.split()[1]] for c in MEASURES.split(", ")]]

    def run(batches):
        types: list = []

        def noted(it):
            nonlocal types
            for batch in it:
                types = [batch.column(i).type for i in range(len(scope))]
                yield batch

        made: list[tuple[list, list]] = []  # closes and ticks of each candidate's bars
        for own, held, over in bars.scopes_of(noted(batches), len(scope), lambda given: bars.Scope("run", given or shared, min_ticks, least_ticks)):
            folds = held.finish() if over else held.folds or []
            made += [([], []) for _ in range(len(made), len(folds))]
            for (close, count), fold in zip(made, folds, strict=False):
                close += [bar[6] for bar in fold.bars]
                count += [bar[7] for bar in fold.bars]
                fold.bars = []
            if stop_at is not None and held.folds:
                done = next((i for i, (close, _) in enumerate(made[: len(folds)]) if len(close) >= stop_at), None)
                if done is not None:
                    held.folds = folds = folds[: done + 1]
            if over:
                rows = [(*c, *measures(np.array(close), np.array(count), lags)) for c, (close, count), _ in zip(held.candidates, made, folds, strict=False)]
                made = []
                if rows:
                    keys = [pa.array([v] * len(rows), type=t) for v, t in zip(own, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*keys, *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)]], names=names)

    ddl = ", ".join(f"{c} {kinds[c]}" for c in scope) + ", param_id int, exp_lambda double, init_exp_t double, " + MEASURES
    return bars.laid_out(ticks, scope, candidates if per_scope else None).mapInArrow(run, ddl)


def first_best(found: DataFrame, by: list[str], *order: Column) -> DataFrame:
    """One row a key by ``order``, then the smaller candidate; reduced before the shuffle."""
    rank = F.struct(*order, (-F.col("param_id")).alias("_id"))
    return found.groupBy(*by).agg(F.max_by(F.struct(*found.columns), rank).alias("_best")).select("_best.*")


# -- one day ------------------------------------------------------------------


def day_bounds(days: DataFrame, defaults: dict[str, float] | None = None, other: float = OTHER_T, least: float = 100.0) -> DataFrame:
    """Bounds of a day's own search: lambda from 0.97 to 0.9999, T from ``least`` to three times the symbol's default."""
    default = F.lit(other)
    for symbol, t in (DEFAULT_T if defaults is None else defaults).items():
        default = F.when(F.col("symbol") == symbol, F.lit(float(t))).otherwise(default)
    return days.withColumns({"t_min": F.lit(float(least)), "t_max": F.floor(default * 3).cast("double"), "lambda_min": F.lit(0.97), "lambda_max": F.lit(0.9999)})


def day_search(
    ticks: DataFrame, scope: list[str], candidates: DataFrame | list[tuple[int, float, float]], min_ticks: int = 400, least_ticks: int = 100, least_bars: int = 5, enough: int = 40
) -> DataFrame:
    """The winner of each scope's own search: ``scope, param_id, exp_lambda, init_exp_t, bars, mean_ticks, meets``.

    Trials are taken in order up to the first with twice ``enough`` bars; the
    one with most bars wins, the first of equals; those of under ``least_bars``
    bars are pruned.  Scopes of under ``least_ticks`` ticks, and those where
    all are pruned, have no row.
    """
    found = score_candidates(ticks, scope, candidates, min_ticks, least_ticks, 2 * enough).where(F.col("bars") >= least_bars)
    best = first_best(found, scope, F.col("bars").alias("_bars"))
    return best.select(*scope, "param_id", "exp_lambda", "init_exp_t", "bars", "mean_ticks", (F.col("bars") >= enough).alias("meets"))


# -- failed days --------------------------------------------------------------


def month_of(day: str = "day") -> Column:
    return F.date_format(day, "yyyy-MM")


def failed_day_candidates(failed: DataFrame, studies: DataFrame, n: int = 30, defaults: dict | None = None, least_t: float = 100.0) -> DataFrame:
    """``(symbol, day, candidates)``: T within half of the previous study's T to one and a half times it, lambda from 0.99 to 0.999.

    The study is the latest before the month that precedes the failed day's.
    """
    wanted = failed.select("symbol", "day").distinct().withColumn("month", month_of())
    before = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), -1), "yyyy-MM")
    targets = wanted.select("symbol", "month").distinct().withColumn("period", before)
    base = joins.param_lookup(targets, studies, defaults or {"exp_lambda": 0.9975, "init_exp_t": 2000.0})
    lo = F.greatest(F.lit(float(least_t)), F.floor(F.col("init_exp_t") * 0.5))
    hi = F.greatest(lo + least_t, F.floor(F.col("init_exp_t") * 1.5))
    bounds = base.select("symbol", "month", lo.alias("t_min"), hi.alias("t_max"), F.lit(0.99).alias("lambda_min"), F.lit(0.999).alias("lambda_max"))
    return wanted.join(spread_candidates(bounds, ["symbol", "month"], n), ["symbol", "month"]).select("symbol", "day", "candidates")


def recovery_objective(days: DataFrame, by: list[str], least_bars: int = 40, least_rate: float = 0.4) -> DataFrame:
    """A candidate's days (``bars, quality_score``) as one row: half success, 35 % quality, 15 % steadiness of quality, each out of 100.

    A day succeeds with ``least_bars`` bars; quality is that of its successful
    days; under ``least_rate`` of successes the score is 0.
    """
    won = F.col("bars") >= least_bars
    quality = F.when(won, F.col("quality_score"))
    out = days.groupBy(*by, "param_id", "exp_lambda", "init_exp_t").agg(
        F.count("*").alias("days"), F.count_if(won).alias("successes"), F.avg(quality).alias("mean_quality"), F.stddev_pop(quality).alias("_std"),
    )
    rate = F.col("successes") / F.col("days")
    score = 50 * rate + 0.35 * F.col("mean_quality") + 0.15 * F.greatest(F.lit(0.0), 100 - F.col("_std"))
    out = out.withColumns({"success_rate": rate, "score": F.when((F.col("successes") == 0) | (rate < least_rate), 0.0).otherwise(score)})
    return out.withColumn("mean_quality", F.coalesce("mean_quality", F.lit(0.0))).drop("_std")


def failed_day_search(
    ticks: DataFrame, failed: DataFrame, studies: DataFrame, n: int = 30, min_ticks: int = 400, least_bars: int = 40, defaults: dict | None = None, least_t: float = 100.0
) -> DataFrame:
    """Parameters that recover a month's failed days best, a row for each symbol and month; of equal scores the first.

    ``ticks`` with ``day``; ``failed``: ``symbol, day``.  All candidates of all
    failed days are folded in one job.  A failed day without ticks does not
    count; a month without any has no row.
    """
    lists = failed_day_candidates(failed, studies, n, defaults, least_t)
    own = ticks.join(failed.select("symbol", "day").distinct(), ["symbol", "day"], "left_semi")
    days = score_candidates(own, ["symbol", "day"], lists, min_ticks).withColumn("month", month_of())
    scored = recovery_objective(days, ["symbol", "month"], least_bars)
    return first_best(scored, ["symbol", "month"], F.col("score").alias("_score"))


def recovered_bars(ticks: DataFrame, failed: DataFrame, found: DataFrame, min_ticks: int = 400, least_bars: int = 40) -> DataFrame:
    """Bars of the failed days under the parameters that ``found`` has for their month; days of fewer bars stay failed."""
    one = F.array(F.struct("param_id", "exp_lambda", "init_exp_t")).alias("candidates")
    wanted = failed.select("symbol", "day").distinct().withColumn("month", month_of())
    lists = wanted.join(found.select("symbol", "month", one), ["symbol", "month"]).select("symbol", "day", "candidates")
    own = ticks.join(wanted, ["symbol", "day"], "left_semi")
    made = bars.candidate_bars(own, ["symbol", "day"], lists, min_ticks).drop("param_id")
    return made.withColumn("_n", F.count("*").over(Window.partitionBy("symbol", "day"))).where(F.col("_n") >= least_bars).drop("_n")
