"""Builds: months of bars with their provenance, walk-forward frames, and days appended with recovery.

Symbols, periods and days are partition keys, never loops: one job builds all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import bars, features, joins, quality, ticks, trials, winsor
from barloom.plans.pipelines import CLIPPED, symbol_defaults
from barloom.sources import sinks

#: Failed days of a month from which on a search for their parameters is worth it.
MIN_FAILED = 3


def month(time: str = "ts") -> Column:
    return F.date_format(time, "yyyy-MM")


def _tagged(raw: DataFrame, period: Column | None) -> DataFrame:
    return raw.withColumns({"day": F.to_date("ts"), "period": month() if period is None else period})


def loaded_periods(raw: DataFrame, min_days: int, period: Column | None = None) -> DataFrame:
    """``symbol, period`` with ticks on at least ``min_days`` days."""
    days = _tagged(raw, period).groupBy("symbol", "period", "day").agg(F.lit(1))
    return days.groupBy("symbol", "period").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_days).select("symbol", "period")


def _one_candidate(params: DataFrame, keys: list[str]) -> DataFrame:
    return params.select(*keys, F.array(F.struct(F.lit(0).alias("param_id"), F.col("exp_lambda").cast("double").alias("exp_lambda"), F.col("init_exp_t").cast("double").alias("init_exp_t"))).alias("candidates"))


def month_days(
    raw: DataFrame, params: DataFrame, min_days: int = 15, min_bars: int = 40, min_ticks: int = 400, width: int = 100, k: float = 10.0, period: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Bars of every day of the loaded periods, each day a fold of its own, and a row of counts for each of those days.

    ``params``: ``symbol, period, exp_lambda, init_exp_t``.  Bars carry
    ``bar_date``, ``base_failed_day`` (1 where the day has under ``min_bars``
    bars) and ``recovered_bar`` (false).  Counts: received = invalid +
    mad_removed + clean (copies count as removed), clean = consumed + residual.
    Periods with ticks on fewer than ``min_days`` days have neither; periods
    without parameters have no bars.
    """
    tagged = _tagged(raw, period)
    loaded = loaded_periods(raw, min_days, period)
    wanted = tagged.join(loaded, ["symbol", "period"], "left_semi")
    clean = ticks.mad_filter(ticks.normalise(wanted), ["symbol", "day"], width, k)
    days = wanted.select("symbol", "day", "period").distinct()
    lists = _one_candidate(days.join(params, ["symbol", "period"]), ["symbol", "day"])
    made = bars.candidate_bars(clean, ["symbol", "day"], lists, min_ticks).drop("param_id")
    count = F.count("*").over(Window.partitionBy("symbol", "day"))
    provenance = {"bar_date": F.col("day"), "base_failed_day": (count < min_bars).cast("int"), "recovered_bar": F.lit(False)}
    received = wanted.groupBy("symbol", "day").agg(F.count("*").alias("received"), F.count_if((F.col("price") <= 0) | (F.col("quantity") <= 0)).alias("invalid"))
    kept = clean.groupBy("symbol", "day").agg(F.count("*").alias("clean"))
    used = made.groupBy("symbol", "day").agg(F.sum("n_ticks").alias("consumed"), F.count("*").alias("bars"))
    audit = received.join(kept, ["symbol", "day"], "left").join(used, ["symbol", "day"], "left").na.fill(0, ["clean", "consumed", "bars"])
    audit = audit.select(
        "symbol", "day", F.lit("base").alias("source"), "received", "invalid", F.greatest(F.lit(0), F.col("received") - F.col("invalid") - F.col("clean")).cast("long").alias("mad_removed"),
        "clean", "consumed", (F.col("clean") - F.col("consumed")).alias("residual"), "bars", F.when(F.col("clean") == 0, "empty_after_clean").otherwise("").alias("errors"),
    )
    return made.withColumns(provenance), audit


def whole_periods(
    raw: DataFrame, params: DataFrame, min_days: int = 15, min_ticks: int = 400, width: int = 100, k: float = 10.0, period: Column | None = None
) -> DataFrame:
    """Bars that run through the days of each loaded period, with their parameters; filter and fold span the period."""
    loaded = loaded_periods(raw, min_days, period)
    wanted = _tagged(raw, period).join(loaded, ["symbol", "period"], "left_semi")
    clean = ticks.mad_filter(ticks.normalise(wanted), ["symbol", "period"], width, k)
    lists = _one_candidate(loaded.join(params, ["symbol", "period"]), ["symbol", "period"])
    return bars.candidate_bars(clean, ["symbol", "period"], lists, min_ticks).drop("param_id")


def walk_forward(
    raw: DataFrame, studies: DataFrame, funding: DataFrame | None = None, min_days: int = 15, min_ticks: int = 400, width: int = 100, k: float = 10.0,
    defaults: dict | None = None, period: Column | None = None, clipped: list[str] | None = None, required: list[str] | None = None,
) -> DataFrame:
    """Training rows period by period: parameters of the latest study before each, features that look back over periods, bounds from earlier ones.

    Rows carry ``symbol, period, year, month, study_source``; those that miss a
    ``required`` feature (by default any) go.
    """
    params = joins.param_lookup(loaded_periods(raw, min_days, period), studies, defaults or symbol_defaults()).withColumnRenamed("source", "study_source")
    made = whole_periods(raw, params, min_days, min_ticks, width, k, period)
    rows = winsor.clip_accumulating(features.compute_features(made, funding, required=required), CLIPPED if clipped is None else clipped, "period")
    tagged = rows.withColumns({"year": F.year("open_time"), "month": F.month("open_time")})
    return tagged.join(params.select("symbol", "period", "study_source"), ["symbol", "period"])


def bars_with_recovery(
    clean: DataFrame, wanted: DataFrame, studies: DataFrame, n: int = 30, min_bars: int = 40, min_failed: int = MIN_FAILED, min_ticks: int = 400,
    defaults: dict | None = None, least_t: float = 100.0,
) -> DataFrame:
    """Bars of the wanted days (``symbol, day``): base bars, and for failed days those of a search where it recovers them.

    ``clean`` ticks with ``day``.  A day fails with under ``min_bars`` bars; a
    month's failed days are searched if there are ``min_failed`` of them.  Days
    that stay failed keep their base bars at ``failed_day`` 1 and half weight;
    one without any bar has none.  ``study_source`` names the study, or the
    search, that a day's parameters are from.  What later steps read more than once is a
    written table.
    """
    keys = ["symbol", "day"]
    own = sinks.kept(clean.join(wanted.select(*keys).distinct(), keys, "left_semi"), "ticks")  # read by three folds
    days = own.select(*keys).distinct()
    params = joins.param_lookup(days.withColumn("period", month("day")), studies, defaults or symbol_defaults())
    base = sinks.kept(bars.candidate_bars(own, keys, _one_candidate(params, keys), min_ticks).drop("param_id"), "base-bars")
    counts = base.groupBy(*keys).agg(F.count("*").alias("_n"))
    failed = sinks.kept(days.join(counts, keys, "left").where(F.coalesce("_n", F.lit(0)) < min_bars).select(*keys), "failed-days")
    often = failed.groupBy("symbol", month("day").alias("month")).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_failed).drop("_n")
    eligible = failed.withColumn("month", month("day")).join(often, ["symbol", "month"], "left_semi").select(*keys)
    found = sinks.kept(trials.failed_day_search(own, eligible, studies, n, min_ticks, min_bars, defaults or symbol_defaults(), least_t), "found")
    recovered = sinks.kept(trials.recovered_bars(own, eligible, found, min_ticks, min_bars).withColumn("recovered", F.lit(True)), "recovered")
    merged = bars.merge_recovered(base.withColumn("recovered", F.lit(False)), recovered)
    lost = failed.join(recovered.select(*keys).distinct(), keys, "left_anti")
    marked = quality.mark_failed_days(merged, lost).join(params.select(*keys, F.col("source").alias("study_source")), keys)
    search = F.concat(F.lit("failed_days_"), F.date_format("day", "yyyy_MM"))
    return marked.withColumns({
        "study_source": F.when(F.col("recovered"), search).otherwise(F.col("study_source")),
        "recovery_status": quality.recovery_status(F.col("recovered"), F.col("failed_day") == 1),
    })


def process_days(
    raw: DataFrame, store: DataFrame, days: DataFrame, studies: DataFrame, min_failed: int = 1, tail: int = 600, width: int = 100, k: float = 10.0, clipped: list[str] | None = None, **search
) -> DataFrame:
    """New rows for chosen days (``symbol, day``) that the store lacks: bars with recovery, and features behind the store's last bars before them.

    Each symbol looks back on the ``tail`` bars before its first new day, whose
    bounds clip the new rows.  ``search``: options of ``bars_with_recovery``.
    """
    keys = ["symbol", "day"]
    wanted = days.select(*keys).distinct().join(store.select(*keys).distinct(), keys, "left_anti")
    tagged = raw.withColumn("day", F.to_date("ts")).join(wanted, keys, "left_semi")
    clean = ticks.mad_filter(ticks.normalise(tagged), keys, width, k)
    new = bars_with_recovery(clean, wanted, studies, min_failed=min_failed, **search)
    firsts = wanted.groupBy("symbol").agg(F.min("day").alias("_first"))  # a row a symbol
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("open_time")))
    before = store.join(firsts, "symbol").where(F.col("day") < F.col("_first")).withColumn("_r", newest).where(F.col("_r") <= tail)
    shared = [*keys, *[c.strip() for c in bars.BAR.split(",")]]
    both = before.select(*shared).withColumn("is_context", F.lit(True)).unionByName(new.withColumn("is_context", F.lit(False)), allowMissingColumns=True)
    return winsor.fit_on_context(features.bar_features(both), CLIPPED if clipped is None else clipped, F.col("is_context")).drop("is_context")


def append_range(raw: DataFrame, store: DataFrame, first: str, last: str, studies: DataFrame, min_failed: int = MIN_FAILED, **options) -> DataFrame:
    """``process_days`` for all days of ``raw`` from ``first`` to ``last``; a second run over the store it was added to gives nothing."""
    day = F.to_date("ts")
    days = raw.where((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date"))).select("symbol", day.alias("day")).distinct()
    return process_days(raw, store, days, studies, min_failed, **options)


def append_report(rows: DataFrame, asked: DataFrame, store: DataFrame) -> DataFrame:
    """What became of the asked days (``symbol, day``), a row a symbol: ``asked, skipped`` (in the store), ``appended, recovered, failed, empty``."""
    keys = ["symbol", "day"]
    status = rows.groupBy(*keys).agg(F.max("recovery_status").alias("status"))
    had = store.select(*keys).distinct().withColumn("had", F.lit(True))
    each = asked.select(*keys).distinct().join(had, keys, "left").join(status, keys, "left")
    of = lambda s: F.count_if(F.col("status") == s)
    return each.groupBy("symbol").agg(
        F.count("*").alias("asked"), F.count_if("had").alias("skipped"), F.count_if(F.col("status").isNotNull()).alias("appended"),
        of("recovered").alias("recovered"), of("failed_irrecoverable").alias("failed"), F.count_if(F.col("had").isNull() & F.col("status").isNull()).alias("empty"),
    )


#: Columns of a daily file, whatever its bars.
FILE_COLUMNS = ["symbol", *[c.strip() for c in bars.BAR.split(",")]]


def historic_files(raw: DataFrame, path: str, minutes: tuple[int, ...] = (1, 5, 15, 30, 60), params: DataFrame | None = None, min_ticks: int = 400, width: int | None = 100, k: float = 10.0) -> DataFrame:
    """A folder a symbol, interval and date for clock bars (``5m``) and, with ``params`` (``symbol, exp_lambda, init_exp_t``), run bars (``run``).

    Days that are there are left as they are, so that a stopped run goes on.
    Returns all files that are there then.  Ticks are cleaned once; ``width`` None: without the MAD filter.
    """
    clean = ticks.normalise(raw).withColumn("day", F.to_date("ts"))
    clean = sinks.kept(clean if width is None else ticks.mad_filter(clean, ["symbol", "day"], width, k), "ticks")
    for m in minutes:
        sinks.write_daily_files(bars.time_bars(clean, m).select(FILE_COLUMNS), path, f"{m}m")
    if params is not None:
        days = clean.select("symbol", "day").distinct().join(params, "symbol")
        made = bars.candidate_bars(clean, ["symbol", "day"], _one_candidate(days, ["symbol", "day"]), min_ticks)
        sinks.write_daily_files(made.select(FILE_COLUMNS), path, "run")
    return raw.sparkSession.read.parquet(path)


def migrate(datasets: DataFrame, studies: DataFrame, store: str) -> dict[str, int]:
    """Annual datasets and studies into a store: ``store/bars`` by symbol and day (days that are there are replaced), ``store/studies`` by symbol and period.

    Studies without both parameters are left out; failed dates of studies go to
    ``store/failed_days``, a row each.  Running it again changes nothing.  Returns rows written.
    """
    spark = datasets.sparkSession
    bars_in = datasets.withColumn("day", F.to_date("open_time")).dropna(subset=["symbol", "day"])
    known = studies.where("exp_lambda is not null and init_exp_t is not null")
    old = spark.read.schema(known.schema).parquet(f"{store}/studies") if sinks.exists(spark, f"{store}/studies") else known.limit(0)
    merged = sinks.kept(sinks.upsert(old, known, ["symbol", "period"]), "studies")
    failed = merged.select("symbol", "period", F.explode(F.array_distinct("failed_dates")).alias("failed_date"))
    sinks.replace_days(bars_in, f"{store}/bars")
    merged.write.mode("overwrite").parquet(f"{store}/studies")
    failed.write.mode("overwrite").parquet(f"{store}/failed_days")
    return {"bars": bars_in.count(), "studies": known.count(), "failed_days": failed.count()}
