"""Audits, gates, validation and repair of bar datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.stats import safe

#: Column aliases and the bar columns of the canonical schema.
ALIASES = {"init_exp_t": "init_exp_T", "atr": "atr_pct", "volume_zscore": "volume_z", "volatility": "rolling_volatility", "macd": "macd_hist"}
RECOVERY_STATUSES = ["normal", "recovered", "failed_irrecoverable", "missing_ticks", "excluded_partial"]
BAR_COLUMNS = ["open_time", "close_time", "open", "high", "low", "close", "n_ticks", "volume", "dollar"]


def conform(rows: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Aliases renamed, missing columns added as typed nulls, columns in order."""
    named = rows.withColumnsRenamed({a: c for a, c in ALIASES.items() if a in rows.columns and c not in rows.columns})
    return named.select(*[(F.col(c) if c in named.columns else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])


def missing_columns(rows: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in rows.columns]


def compact(rows: DataFrame) -> DataFrame:
    """Doubles as floats and long counts as ints, for storage only."""
    kinds = dict(rows.dtypes)
    cast = {c: F.col(c).cast("float") for c, t in kinds.items() if t == "double"}
    return rows.withColumns(cast | {c: F.col(c).cast("int") for c in ("n_ticks", "bar_duration_secs") if c in kinds})


def daily_audit(counts: DataFrame) -> DataFrame:
    return counts.withColumn("mad_removed_pct", F.coalesce(100 * safe(F.col("mad_removed"), F.col("received")), F.lit(0.0)))


def gate_daily_audit(audit: DataFrame, max_mad_pct: float = 5.0) -> DataFrame:
    """Errors of each audit row, empty where it passes."""
    checks = [(F.col("mad_removed_pct") > max_mad_pct, "mad_removed_pct above limit")]
    checks += [(F.col(c) < 0, f"negative {c}") for c in ("received", "invalid", "duplicates", "mad_removed", "clean")]
    return audit.withColumn("errors", _messages(checks))


def _messages(checks: list[tuple[Column, str]]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda x: x.isNotNull())


def recovery_status(recovered: Column, failed: Column) -> Column:
    """Recovered wins over failed; null is neither."""
    return F.when(F.coalesce(recovered, F.lit(False)), "recovered").when(F.coalesce(failed, F.lit(False)), "failed_irrecoverable").otherwise("normal")


def mark_failed_days(bars: DataFrame, failed: DataFrame, day: str = "day") -> DataFrame:
    """``failed_day`` 0/1 and ``sample_weight`` 0.5/1.0 from a list of ``(symbol, day)``."""
    flagged = failed.select("symbol", day).distinct().withColumn("_failed", F.lit(True))
    out = bars.join(flagged, ["symbol", day], "left")
    is_failed = F.coalesce("_failed", F.lit(False))
    return out.withColumns({"failed_day": is_failed.cast("int"), "sample_weight": F.when(is_failed, 0.5).otherwise(1.0)}).drop("_failed")


def monthly_report(bars: DataFrame, today: str, scores: DataFrame | None = None) -> DataFrame:
    """One row per symbol and month of bars with ``day, recovered, failed_day``.

    ``scores(symbol, month, quality_score)`` adds the score; months of fewer
    than 100 bars have none.
    """
    per_day = bars.groupBy("symbol", "day").agg(
        F.count("*").alias("bars"), F.count_if("recovered").alias("recovered"), F.max(F.col("recovered").cast("int")).alias("is_recovered"), F.max("failed_day").alias("failed"),
    )
    month = F.date_format("day", "yyyy-MM")
    q = lambda p: F.percentile("bars", F.lit(p))
    out = per_day.groupBy("symbol", month.alias("month")).agg(
        F.sum("bars").alias("total_bars"), F.count("*").alias("observed_days"), F.sum("recovered").alias("recovered_bars"),
        F.sum("is_recovered").alias("recovered_days"), F.sum("failed").alias("failed_days"), F.avg("bars").alias("mean_bars"),
        q(0.5).alias("median_bars"), q(0.1).alias("p10_bars"), q(0.9).alias("p90_bars"), F.max(F.dayofmonth(F.last_day("day"))).alias("expected_days"),
    )
    out = out.withColumn("coverage_pct", 100 * safe(F.col("observed_days"), F.col("expected_days")))
    out = out.withColumn("recovery_pct", 100 * safe(F.col("recovered_bars"), F.col("total_bars")))
    out = out.withColumn("normal_bars", F.col("total_bars") - F.col("recovered_bars"))
    out = out.withColumn("recovery_day_pct", 100 * safe(F.col("recovered_days"), F.col("observed_days")))
    if scores is not None:
        out = out.join(scores.select("symbol", "month", "quality_score"), ["symbol", "month"], "left")
        out = out.withColumn("quality_score", F.when(F.col("total_bars") >= 100, F.col("quality_score")))
    return out.withColumn("partial_month", F.col("month") == F.date_format(F.lit(today).cast("date"), "yyyy-MM"))


def gate_monthly(report: DataFrame, max_recovery: float = 50, min_mean: float = 10, min_score: float = 20, allow_partial: bool = True) -> DataFrame:
    """Errors of each month; the current month is excused when ``allow_partial``.  A missing score is no error."""
    strict = ~F.col("partial_month") if allow_partial else F.lit(True)
    checks = [
        (strict & (F.col("recovery_pct") > max_recovery), "recovery_pct"),
        (strict & (F.col("recovery_day_pct") > max_recovery), "recovered_days"),
        (strict & (F.col("mean_bars") < min_mean), "mean_bars"),
    ]
    if "quality_score" in report.columns:
        score = F.col("quality_score")
        checks.append((strict & ~F.isnan(score) & (score < min_score), "quality_score"))
    return report.withColumn("errors", _messages(checks))


def validate_studies(studies: DataFrame, min_completion: float = 0.80, max_failed: float = 0.50) -> DataFrame:
    """Errors of studies with ``completion_rate, failed_days`` (an array, repeats count once) and ``expected_days`` (null or 0: unchecked)."""
    rate, ratio = F.col("completion_rate"), safe(F.size(F.array_distinct("failed_days")), F.col("expected_days"))
    checks = [(~rate.between(0, 1), "completion_rate outside [0, 1]"), (rate < min_completion, "completion_rate too low"), (ratio > max_failed, "too many failed days")]
    out = studies.withColumn("errors", _messages(checks))
    return out.withColumn("valid", F.size("errors") == 0)


#: Of the features those that must move when prices do.
DYNAMIC = ["log_return", "frac_diff_return", "rolling_volatility", "atr_pct", "vwap", "rsi", "bb_pct_b", "macd_hist"]


def _not_finite(c: str) -> Column:
    return F.isnan(c) | F.abs(F.col(c)).isin(float("inf"))


def validate_frame(
    frame: DataFrame, features: list[str], year: int, min_bars: int = 1, dynamic: list[str] | None = None, allow_partial: bool = True, symbol: str | None = None
) -> DataFrame:
    """One row per symbol with ``bars, errors, warnings, valid``; a single aggregation over the frame.

    A frame without rows has one row, for ``symbol``, whose error says so;
    columns that are missing are an error of each row, and what needs them is
    not asked.  ``dynamic`` features (by default those of ``DYNAMIC``) must not be constant while the core
    columns vary.  Rows of a table have no order, so whether times ascend is
    not asked.  Optional columns (funding_rate_mean, completion_rate,
    sample_weight, recovery_status) are checked where present.
    """
    gone = [c for c in [*BAR_COLUMNS, *features] if c not in frame.columns]
    frame = frame.withColumns({c: F.lit(None).cast("timestamp_ntz" if c.endswith("_time") else "double") for c in BAR_COLUMNS if c in gone} | ({} if "symbol" in frame.columns else {"symbol": F.lit(None).cast("string")}))
    features = [c for c in features if c not in gone]
    has = set(frame.columns) - set(gone)
    prices = [c for c in ("open", "high", "low", "close", "volume", "dollar", "n_ticks") if c in has]
    frame = frame.withColumns({c: F.col(c).cast("double") for c in {*prices, *features, *({"funding_rate_mean", "completion_rate", "sample_weight"} & has)}})
    dynamic = [c for c in (DYNAMIC if dynamic is None else dynamic) if c in features]
    wrong = (F.col("high") < F.greatest("low", "open", "close")) | (F.col("low") > F.least("open", "close")) | (F.col("volume") < 0)
    agg = {
        "bars": F.count("*"), "no_time": F.count_if(F.col("open_time").isNull()), "outside": F.count_if(F.year("open_time") != year),
        "same_time": F.count("*") - F.count_distinct("open_time"), "first_time": F.min("open_time"), "last_time": F.max("open_time"),
        "ohlcv_null": F.count_if(_any([F.col(c).isNull() | F.isnan(c) for c in prices])), "ohlcv_infinite": F.count_if(_any([_not_finite(c) for c in prices])), "inconsistent": F.count_if(wrong),
        "varies": _any([F.min(c) < F.max(c) for c in prices]),
    }
    agg |= {f"null_{c}": F.count_if(F.col(c).isNull() | F.isnan(c)) for c in features} | {f"infinite_{c}": F.count_if(_not_finite(c)) for c in features}
    agg |= {f"flat_{c}": F.coalesce(F.min(c) == F.max(c), F.lit(True)) for c in dynamic}
    absent = F.lit(bool(gone)), f"missing columns: {', '.join(gone)}"
    checks = [
        absent, (F.col("bars") < min_bars, "too few bars"), (F.lit("open_time" in has) & (F.col("no_time") > 0), "null open_time"), (F.col("outside") > 0, "outside year"),
        (F.col("ohlcv_null") > 0, "ohlcv null"), (F.col("ohlcv_infinite") > 0, "ohlcv not finite"), (F.col("inconsistent") > 0, "ohlcv inconsistent"),
    ]
    if not allow_partial:
        month = F.expr("interval 31 days")
        checks += [(F.col("first_time") > F.lit(f"{year}-01-01").cast("timestamp_ntz") + month, "starts too late"), (F.col("last_time") < F.lit(f"{year}-12-31 23:59:59").cast("timestamp_ntz") - month, "ends too early")]
    checks += [(F.col(f"null_{c}") > 0, f"{c} null") for c in features] + [(F.col(f"infinite_{c}") > 0, f"{c} not finite") for c in features]
    checks += [(F.col(f"flat_{c}") & F.col("varies"), f"{c} constant") for c in dynamic]
    optional = {
        "funding_rate_mean": lambda c: F.col(c).isNull() | F.isnan(c) | _not_finite(c),
        "completion_rate": lambda c: F.col(c).isNull() | ~F.col(c).between(0, 1),
        "sample_weight": lambda c: F.col(c).isNull() | ~F.col(c).isin(0.5, 1.0),
        "recovery_status": lambda c: F.col(c).isNull() | ~F.col(c).isin(RECOVERY_STATUSES),
    }
    for c, bad in optional.items():
        if c in has:
            agg[f"bad_{c}"] = F.count_if(bad(c))
            checks.append((F.col(f"bad_{c}") > 0, f"{c} unsupported"))
    if symbol is not None:
        checks.append((F.coalesce(F.col("symbol") != symbol, F.lit(True)), "unexpected symbol"))
    out = frame.groupBy("symbol").agg(*[v.alias(k) for k, v in agg.items()])
    out = out.select("symbol", "bars", _messages(checks).alias("errors"), _messages([(F.col("same_time") > 0, "duplicate timestamps")]).alias("warnings"))
    # One row in front, so that a frame without rows has a verdict too; the other side has a row a symbol.
    said = frame.sparkSession.range(1).select(F.lit(0).alias("_one")).join(out, F.lit(True), "left")
    empty = F.col("bars").isNull()
    said = said.select(
        F.coalesce("symbol", F.when(empty, F.lit(symbol))).alias("symbol"), F.coalesce("bars", F.lit(0)).alias("bars"),
        F.when(empty, F.array(F.lit("frame is empty"))).otherwise(F.col("errors")).alias("errors"), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
    )
    return said.withColumn("valid", F.size("errors") == 0)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def value_sets(frame: DataFrame, columns: dict[str, list | None]) -> DataFrame:
    """``column, values, unexpected``: the distinct values of each column as sorted strings, and those outside its allowed list (None: anything).

    For columns of few values (source, status, symbol); null counts as ``null``.  One pass, reduced before the shuffle.
    """
    long = frame.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("value")) for c in columns])).alias("_e")).select("_e.*")
    sets = long.groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("values"))
    allowed = F.lit(None).cast("array<string>")
    for c, values in columns.items():
        if values is not None:
            allowed = F.when(F.col("column") == c, F.array(*[F.lit(str(v)) for v in values]).cast("array<string>")).otherwise(allowed)
    return sets.withColumn("unexpected", F.when(allowed.isNull(), F.array().cast("array<string>")).otherwise(F.array_except("values", F.coalesce(allowed, F.array().cast("array<string>")))))


def distinct_values(frame: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """How many distinct non-null values each column has per key: one shuffle for all of them."""
    long = frame.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("_e")).select(*by, "_e.*")
    return long.where("value is not null").distinct().groupBy(*by, "column").agg(F.count("*").alias("distinct_values"))


#: Bars that agree in these are copies.
COPY_KEYS = ["symbol", "open_time", "open", "high", "low", "close", "volume"]


def deduplicate_exact(bars: DataFrame) -> DataFrame:
    """Of bars that agree in the key columns present one stays: the least in its other columns, as rows have no order."""
    keys = [c for c in COPY_KEYS if c in bars.columns]
    rest = [c for c in bars.columns if c not in keys]
    if not rest:
        return bars.distinct()
    return bars.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest")).select(*keys, "_rest.*").select(bars.columns)


def keep_most_liquid(bars: DataFrame) -> DataFrame:
    """Of bars that share an open time the one with most dollars, then most volume, stays."""
    rest = [c for c in bars.columns if c not in ("symbol", "open_time")]
    best = F.max_by(F.struct(*rest), F.struct("dollar", "volume", "close_time", "close")).alias("b")
    return bars.groupBy("symbol", "open_time").agg(best).select("symbol", "open_time", "b.*").select(bars.columns)


def integrity_score(bars: DataFrame) -> DataFrame:
    """100 points less 20 for exact copies, up to 30 for missing values, 15 for shared times, 10 for bad OHLC."""
    keys = bars.groupBy(*bars.columns).agg(F.count("*").alias("_n"))
    agg = keys.groupBy("symbol").agg(
        F.sum("_n").alias("bars"), F.sum(F.col("_n") - 1).alias("copies"),
        F.sum(F.when(F.expr("open is null or high is null or low is null or close is null"), F.col("_n")).otherwise(0)).alias("missing"),
        (F.sum("_n") - F.count_distinct("open_time")).alias("shared"),
        F.sum(F.when((F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close")), F.col("_n")).otherwise(0)).alias("bad"),
    )
    copies, missing = safe(F.col("copies"), F.col("bars")), 100 * safe(F.col("missing"), F.col("bars"))
    score = 100 - F.when(copies > 0.001, 20).otherwise(0) - F.least(F.lit(30.0), 10 * missing) - F.when(F.col("shared") > 0, 15).otherwise(0) - F.when(F.col("bad") > 0, 10).otherwise(0)
    return agg.withColumn("score", score.cast("double"))


#: The range in which 95 % of a feature's values must lie.
FEATURE_RANGES = {"log_return": (-5.0, 5.0), "rsi": (0.0, 100.0), "bb_pct_b": (-0.5, 1.5), "vwap": (0.0, 1e6)}


def integrity_report(
    frame: DataFrame, year: int, ranges: dict[str, tuple[float, float]] | None = None, least_bars: int = 8000, max_copies: float = 0.001, max_null: float = 0.01, max_outside: float = 0.05
) -> DataFrame:
    """What a published dataset fails, a row a symbol: ``bars, copies, shared_times, worst_null, failed`` (names of checks) in two aggregations.

    Checks: enough bars, first and last time within 30 days of the year's
    ends, exact copies, missing values of any column, weights other than 0.5
    and 1, OHLC that contradict each other, and features out of range.
    """
    ranges = {c: r for c, r in (FEATURE_RANGES if ranges is None else ranges).items() if c in frame.columns}
    n = F.col("_n")
    share = lambda condition: F.sum(F.when(condition, n).otherwise(0)) / F.sum(n)
    counted = frame.groupBy(*frame.columns).agg(F.count("*").alias("_n"))  # copies meet before anything else
    nulls = [share(F.col(c).isNull()) for c in frame.columns if c != "symbol"]
    weight = F.col("sample_weight") if "sample_weight" in frame.columns else F.lit(1.0)
    bad = (F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close"))
    out = counted.groupBy("symbol").agg(
        F.sum("_n").alias("bars"), F.sum(n - 1).alias("copies"), (F.count("*") - F.count_distinct("open_time")).alias("shared_times"), F.greatest(*nulls, F.lit(0.0)).alias("worst_null"),
        F.min("open_time").alias("_first"), F.max("open_time").alias("_last"), share(~F.coalesce(weight.isin(0.5, 1.0), F.lit(False))).alias("_weights"), share(bad).alias("_bad"),
        *[share(~F.col(c).between(lo, hi)).alias(f"_range_{c}") for c, (lo, hi) in ranges.items()],
    )
    month = F.expr("interval 30 days")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (f"{year}-01-01", f"{year}-12-31"))
    checks = [
        (F.col("bars") < least_bars, "bars"), ((F.col("_first") > start + month) | (F.col("_last") < end - month) | (F.year("_first") < year) | (F.year("_last") > year), "dates"),
        (F.col("copies") / F.col("bars") > max_copies, "copies"), (F.col("shared_times") > 0, "times"), (F.col("worst_null") > max_null, "nulls"), (F.col("_weights") > 0, "weights"), (F.col("_bad") > 0, "ohlc"),
        *[(F.col(f"_range_{c}") > max_outside, f"range of {c}") for c in ranges],
    ]
    return out.select("symbol", "bars", "copies", "shared_times", "worst_null", _messages(checks).alias("failed"))


def date_sets(wanted: DataFrame, there: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every ``symbol, day`` of either side once, and ``side``: ``both``, ``wanted`` (missing) or ``there`` (unasked): union, intersection and differences in one shuffle."""
    keys = keys or ["symbol", "day"]
    marked = wanted.select(*keys, F.lit(1).alias("_s")).unionByName(there.select(*keys, F.lit(2).alias("_s")))
    sides = marked.groupBy(*keys).agg(F.bit_or("_s").alias("_s"))
    return sides.select(*keys, F.when(F.col("_s") == 3, "both").when(F.col("_s") == 1, "wanted").otherwise("there").alias("side"))


def study_summary(studies: DataFrame, failed: DataFrame, bars: DataFrame, faithful: bool = False) -> DataFrame:
    """Study, failed days and bars per symbol and period; faithful keeps the fan-out of the plain joins."""
    keys = ["symbol", "period"]
    if faithful:
        joined = studies.join(failed, keys, "left").join(bars.select(*keys, "close"), keys, "left")
        return joined.groupBy(*keys, "exp_lambda").agg(F.count_distinct("failed_date").alias("failed_days"), F.avg("close").alias("mean_close"), F.count("*").alias("rows"))
    f = failed.groupBy(*keys).agg(F.count_distinct("failed_date").alias("failed_days"))
    b = bars.groupBy(*keys).agg(F.avg("close").alias("mean_close"), F.count("*").alias("rows"))
    return studies.join(f, keys, "left").join(b, keys, "left").select(*keys, "exp_lambda", F.coalesce("failed_days", F.lit(0)).alias("failed_days"), "mean_close", F.coalesce("rows", F.lit(0)).alias("rows"))


def fallback_choice(levels: DataFrame, min_bars: int = 40) -> DataFrame:
    """The lowest level with enough bars per ``(symbol, day)``, else the highest level there is."""
    order = Window.partitionBy("symbol", "day").orderBy(F.when(F.col("bars") >= min_bars, F.col("level")).otherwise(1000 - F.col("level")))
    return levels.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
