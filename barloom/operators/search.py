"""Walk-forward splits and parameter search; all candidates are evaluated in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.stats import safe


@dataclass(frozen=True)
class WindowSpec:
    """Half-open train, validation and test windows, a label horizon and an embargo in hours."""

    train_start: str
    train_end: str
    val_start: str
    val_end: str
    test_start: str
    test_end: str
    horizon_hours: int = 0
    embargo_hours: int = 0

    def inside(self, t: Column, name: str) -> Column:
        first, last = (F.lit(getattr(self, f"{name}_{x}")).cast("timestamp_ntz") for x in ("start", "end"))
        return (t >= first) & (t < last)

    def not_purged(self, close: Column, boundary: str) -> Column:
        """The label, known ``horizon`` after the close, must end ``embargo`` before the boundary."""
        hours = self.horizon_hours + self.embargo_hours
        return close + F.expr(f"interval {hours} hours") <= F.lit(boundary).cast("timestamp_ntz")


def assign_splits(bars: DataFrame, spec: WindowSpec) -> DataFrame:
    t, c = F.col("open_time"), F.col("close_time")
    train, val, test = (spec.inside(t, n) for n in ("train", "val", "test"))
    split = (
        F.when(train & spec.not_purged(c, spec.val_start), "train").when(train, "purged")
        .when(val & spec.not_purged(c, spec.test_start), "validation").when(val, "purged").when(test, "test").otherwise("outside")
    )
    return bars.withColumn("split", split)


def validation_leaderboard(trials: DataFrame) -> DataFrame:
    """By validation score, with the gap to training; robust trials have at most the median gap and, where there is such a column, a stability."""
    scored = trials.where("validation_score is not null").withColumn("gap", F.greatest(F.col("train_score") - F.col("validation_score"), F.lit(0.0)))
    steady = F.col("stability").isNotNull() if "stability" in trials.columns else F.lit(True)
    middle = scored.agg(F.percentile("gap", F.lit(0.5)).alias("median_gap"))  # one row
    out = scored.crossJoin(F.broadcast(middle)).withColumn("robust", F.coalesce(F.col("gap") <= F.col("median_gap"), F.lit(False)) & steady).drop("median_gap")
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("validation_score"), "trial")))


def composite_score(days: DataFrame, by: list[str], min_bars: int = 50, max_t: float = 11_000, floor: float = 0.6) -> DataFrame:
    """Objective of a candidate from its days' ``bars`` and ``quality``."""
    good = F.col("bars") >= min_bars
    out = days.groupBy(*by).agg(F.count("*").alias("days"), F.avg(good.cast("double")).alias("completion"), F.avg(F.when(good, F.col("quality"))).alias("mean_quality"), F.stddev_pop(F.when(good, F.col("quality"))).alias("std_quality"))
    score = 0.60 * F.col("mean_quality") + 0.25 * 100 * F.pow("completion", F.lit(0.3)) + 0.15 * 100 / (1 + F.col("std_quality") / 20)
    failed = (F.col("completion") < floor) | (F.col("init_exp_t") > max_t) if "init_exp_t" in by else F.col("completion") < floor
    return out.withColumn("score", F.when(failed, 0.0).otherwise(F.coalesce(score, F.lit(0.0))))


def stopped_early(trials: DataFrame, by: list[str], pruned: int = 10, stale: int = 15, least_gain: float = 1e-6) -> DataFrame:
    """Where each study's trials would have stopped: ``by, ran, stopped_at, reason`` (null if never) from ``(by, trial, state, value)``.

    A study stops at the last of ``pruned`` pruned trials in a row, or at a
    complete trial that is the ``stale``-th without a gain over the best value
    seen.  Pruned trials, and complete ones before any positive value, age the
    study too; failed ones only break a row of pruned ones.  One pass over a
    study's own trials, in order.
    """
    step = F.struct("trial", "state", "value")
    ordered = F.array_sort(F.collect_list(step))
    start = F.expr("named_struct('row', 0, 'age', 0, 'best', cast(null as double), 'seen', cast(null as double), 'ran', 0L, 'at', cast(null as bigint), 'reason', cast(null as string))")

    def take(s: Column, t: Column) -> Column:
        lost, done = t["state"] == "PRUNED", t["state"] == "COMPLETE"
        best = F.when(done, F.greatest(s["best"], t["value"])).otherwise(s["best"])
        gained = done & (best > 0) & F.coalesce(best > s["seen"] + least_gain, F.lit(True))
        age = F.when(gained, 0).when(lost | done, s["age"] + 1).otherwise(s["age"])
        row = F.when(lost, s["row"] + 1).otherwise(0)
        reason = F.when(lost & (row >= pruned), "pruned").when(done & (best > 0) & ~gained & (age >= stale), "no improvement")
        next_ = F.struct(
            row.alias("row"), age.alias("age"), best.alias("best"), F.when(gained, best).otherwise(s["seen"]).alias("seen"), (s["ran"] + 1).alias("ran"),
            F.when(reason.isNotNull(), t["trial"].cast("long")).alias("at"), reason.alias("reason"),
        )
        return F.when(s["reason"].isNotNull(), s).otherwise(next_)

    out = trials.groupBy(*by).agg(F.aggregate(ordered, start, take).alias("s"))
    return out.select(*by, F.col("s.ran").alias("ran"), F.col("s.at").alias("stopped_at"), F.col("s.reason").alias("reason"))


def grid(spark: SparkSession, lambdas: list[float], sizes: list[float]) -> DataFrame:
    return spark.createDataFrame([(i, lam, float(t)) for i, (lam, t) in enumerate((a, b) for a in lambdas for b in sizes)], "param_id int, exp_lambda double, init_exp_t double")


#: Per symbol the cap of lambda and the floor of T.
LAMBDA_CAPS = {"BTCUSDT": 0.993, "ETHUSDT": 0.995, "SOLUSDT": 0.996, "BNBUSDT": 0.995}
T_FLOORS = {"BTCUSDT": 200, "ETHUSDT": 300, "SOLUSDT": 100, "BNBUSDT": 50}
OTHER_CAP, OTHER_FLOOR = 0.995, 100


def _per_symbol(values: dict, other) -> Column:
    out = F.lit(other)
    for symbol, value in values.items():
        out = F.when(F.col("symbol") == symbol, F.lit(value)).otherwise(out)
    return out


BOUNDS = ["t_min", "t_max", "lambda_min", "lambda_max"]


def adaptive_bounds(trials: DataFrame, current: dict[str, float] | DataFrame, share: int = 5, least: int = 3) -> DataFrame:
    """Bounds of each symbol's next search from the best fifth of its trials with a positive score.

    ``trials``: ``symbol, trial, score, init_exp_t, exp_lambda``; ``current``:
    ``BOUNDS``, for all symbols or (a frame) a row for each, returned for
    symbols with fewer than ``least`` such trials.  T: median less two, plus three, deviations, at
    least the floor, made wider when narrow and when the best trials crowd the
    current edges.  Lambda: two deviations either side, within 0.9 and the cap.
    """
    w = Window.partitionBy("symbol")
    ranked = trials.where("score > 0").withColumns({"_r": F.row_number().over(w.orderBy(F.desc("score"), "trial")), "_n": F.count("*").over(w)})
    top = F.greatest(F.lit(least), F.floor(F.col("_n") / share))
    q = lambda c, p: F.percentile(c, F.lit(p))
    best = ranked.where((F.col("_r") <= top) & (F.col("_n") >= least)).groupBy("symbol").agg(
        q("init_exp_t", 0.5).alias("tc"), F.stddev_pop("init_exp_t").alias("ts"), q("init_exp_t", 0.9).alias("p90"), q("init_exp_t", 0.1).alias("p10"),
        q("exp_lambda", 0.5).alias("lc"), F.stddev_pop("exp_lambda").alias("ls"),
    )
    col, whole = F.col, lambda c: c.cast("long")
    if isinstance(current, DataFrame):
        symbols = current.select("symbol", *[F.col(n).cast("double").alias(f"now_{n}") for n in BOUNDS])
    else:
        symbols = trials.select("symbol").distinct().select("symbol", *[F.lit(float(current[n])).alias(f"now_{n}") for n in BOUNDS])
    out = symbols.join(best, "symbol", "left").withColumns({"floor": _per_symbol(T_FLOORS, OTHER_FLOOR), "cap": _per_symbol(LAMBDA_CAPS, OTHER_CAP)})
    out = out.withColumns({"lo": F.greatest("floor", whole(col("tc") - 2 * col("ts"))), "hi": whole(col("tc") + 3 * col("ts"))})
    narrow = col("hi") - col("lo") < col("floor")
    wide_lo, wide_hi = F.greatest("floor", whole(col("tc") - col("floor"))), whole(col("tc") + col("floor"))
    out = out.withColumns({
        "lo": F.when(narrow, wide_lo).otherwise(col("lo")),
        "hi": F.when(narrow & (wide_hi <= wide_lo), wide_lo * 3).when(narrow, wide_hi).otherwise(col("hi")),
    })
    out = out.withColumns({
        "hi": F.when(col("p90") > col("now_t_max") * 0.85, whole(col("now_t_max") * 1.5)).otherwise(col("hi")),
        "lo": F.when(col("p10") < col("now_t_min") * 1.15, F.greatest("floor", whole(col("now_t_min") * 0.5))).otherwise(col("lo")),
    }).withColumn("hi", F.when(col("hi") <= col("lo"), col("lo") * 3).otherwise(col("hi")))
    out = out.withColumns({"a": F.greatest(F.lit(0.9), col("lc") - 2 * col("ls")), "b": F.least("cap", col("lc") + 2 * col("ls"))})
    apart = lambda a, b: F.when(b <= a, F.least(col("cap"), a + 0.05)).otherwise(b)
    out = out.withColumn("b", apart(col("a"), col("b")))
    near_a, near_b = F.greatest(F.lit(0.96), F.round(col("lc") - 0.015, 4)), F.least(col("cap"), F.round(col("lc") + 0.015, 4))
    tight = col("b") - col("a") < 0.01
    out = out.withColumns({"a": F.when(tight, near_a).otherwise(col("a")), "b": F.when(tight, apart(near_a, near_b)).otherwise(col("b"))})
    found = {"t_min": col("lo"), "t_max": col("hi"), "lambda_min": F.round("a", 4), "lambda_max": F.round("b", 4)}
    derived = col("tc").isNotNull()
    return out.select("symbol", *[F.when(derived, x).otherwise(col(f"now_{n}")).cast("double").alias(n) for n, x in found.items()], derived.alias("derived"))


def regime_window(day_stats: DataFrame, most: int = 3) -> DataFrame:
    """Months of history to use, from the ratios of monthly volume and volatility: ``(symbol, day, dollar, close)``.

    Returns stay within a month; a month without two days has no volatility.
    One month gives one; a volatility ratio over 2 or a volume ratio over 3
    gives one, over 1.5 or 2 gives two, otherwise as many as there are, up to ``most``.
    """
    tagged = day_stats.withColumn("month", F.date_format("day", "yyyy-MM"))
    w = Window.partitionBy("symbol", "month").orderBy("day")
    moved = tagged.withColumn("r", F.ln("close") - F.ln(F.lag("close").over(w)))
    monthly = moved.groupBy("symbol", "month").agg(F.avg("dollar").alias("volume"), F.coalesce(F.stddev_pop("r") * (365**0.5), F.lit(0.0)).alias("vol"))
    ratio = lambda c: F.max(c) / F.greatest(F.min(c), F.lit(1e-10))
    out = monthly.groupBy("symbol").agg(F.count("*").alias("months"), ratio("volume").alias("volume_ratio"), ratio("vol").alias("vol_ratio"))
    severe = (F.col("vol_ratio") > 2) | (F.col("volume_ratio") > 3)
    moderate = (F.col("vol_ratio") > 1.5) | (F.col("volume_ratio") > 2)
    return out.withColumn("window_months", F.when((F.col("months") < 2) | severe, 1).when(moderate, 2).otherwise(F.least("months", F.lit(most))).cast("int"))


def failed_day_tally(failures: DataFrame, n: int = 5) -> DataFrame:
    """Failures per day with how often each reason was given (``reason:count``), the worst ``n`` days first.

    A column ``details`` is collected, each text once, in order.
    """
    more = [F.collect_set("details").alias("_d")] if "details" in failures.columns else []
    each = failures.groupBy("day", "reason").agg(F.count("*").alias("times"), *more)
    named = F.concat_ws(":", "reason", "times")
    texts = [F.array_sort(F.array_distinct(F.flatten(F.collect_list("_d")))).alias("details")] if more else []
    out = each.groupBy("day").agg(F.sum("times").alias("failures"), F.array_join(F.array_sort(F.collect_list(named)), ",").alias("reasons"), *texts)
    return out.orderBy(F.desc("failures"), "day").limit(n)


def viability(days: DataFrame, by: list[str]) -> DataFrame:
    """Trading score of days with ``bars, quality, sharpe``: 40 % quality, 30 % steadiness, 20 % volume, 10 % Sharpe, each out of 100."""
    out = days.groupBy(*by).agg(
        F.avg("bars").alias("mean_bars"), F.coalesce(F.stddev_samp("bars"), F.lit(0.0)).alias("std_bars"),
        F.avg("quality").alias("mean_quality"), F.avg("sharpe").alias("mean_sharpe"),
    )
    within = lambda c, top: F.greatest(F.lit(0.0), F.least(c, F.lit(top)))
    steady = (1 - within(F.col("std_bars") / F.col("mean_bars"), 1.0)) * 100
    volume = F.when(F.col("mean_bars") < 50, 0.0).otherwise(within(F.col("mean_bars") / 300, 1.0) * 100)
    out = out.withColumns({"stability_score": steady, "volume_score": volume})
    score = 0.40 * F.col("mean_quality") + 0.30 * F.col("stability_score") + 0.20 * F.col("volume_score") + 0.10 * within(F.col("mean_sharpe") * 20, 100.0)
    return out.withColumn("trading_score", score)


def sampled_days(days: DataFrame, by: list[str], n: int = 10, seed: int = 7) -> DataFrame:
    """``n`` days a key, the same ones in every run: those with the smallest hash of seed and day."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col("day").cast("string"))), "day"))
    return days.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def has_study(targets: DataFrame, studies: DataFrame) -> DataFrame:
    """``targets(symbol, period)`` with whether a study of that very period is there."""
    known = studies.select("symbol", "period").distinct().withColumn("_known", F.lit(True))
    return targets.join(known, ["symbol", "period"], "left").withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")


def search_run_bars(ticks: DataFrame, params: list[tuple[int, float, float]], scope: list[str], min_ticks: int) -> DataFrame:
    """Bars of every candidate ``(param_id, exp_lambda, init_exp_t)`` in every scope that has any; ticks are shuffled once."""
    from barloom.operators import trials

    found = trials.score_candidates(ticks, scope, params, min_ticks).where("bars > 0")
    return found.select("param_id", "exp_lambda", "init_exp_t", *scope, "bars", "mean_ticks")
