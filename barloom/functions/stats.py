"""Statistics of bars: moments, autocorrelation, portmanteau, variance and unit-root tests, scores."""

from __future__ import annotations

import math
from functools import partial
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: MacKinnon (2010), constant only: critical values at 1 % as a polynomial in 1/n.
ADF_1PCT = (-3.43035, -6.5393, -16.786, -79.433)
#: The same table at 5 %.
ADF_5PCT = (-2.86154, -2.8903, -4.234, -40.040)
#: MacKinnon (1994), constant only: the normal quantile of the p-value as a polynomial in the statistic, at and below ADF_MIDDLE and above it.
ADF_LOW_P = (2.1659, 1.4412, 0.038269)
ADF_HIGH_P = (1.7339, 0.93202, -0.12745, -0.010368)
#: Where the two meet, and beyond which the p-value is 0 or 1.
ADF_MIDDLE, ADF_LEAST, ADF_MOST = -1.61, -18.83, 2.74
#: Royston (1995): the two largest weights as polynomials in 1/sqrt(n), and mean and deviation of the transformed W for up to 11 and for more values.
ROYSTON_LAST = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
ROYSTON_SECOND = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
ROYSTON_FEW = ((-2.273, 0.459), (0.5440, -0.39978, 0.025054, -0.0006714), (1.3822, -0.77857, 0.062767, -0.0020322))
ROYSTON_MANY = ((-1.5861, -0.31082, -0.083751, 0.0038915), (-0.4803, -0.082676, 0.0030302))
#: The approximation is not used from here on.
SHAPIRO_ROWS = 5000


def safe(x: Column, y: Column) -> Column:
    return x / F.nullif(y.cast("double"), F.lit(0.0))


def chi2_survival_even(x: Column, dof: int) -> Column:
    """Exact for an even number of degrees of freedom."""
    half, term, total = x / 2, F.lit(1.0), F.lit(1.0)
    for i in range(1, dof // 2):
        term = term * half / i
        total = total + term
    return F.exp(-half) * total


def moments(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """Population skewness, excess kurtosis, Jarque-Bera and its p-value."""
    out = rows.where(F.col(column).isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"),
        F.skewness(column).alias("skew"), F.kurtosis(column).alias("kurt"),
    )
    jb = F.col("n") / 6.0 * (F.col("skew") ** 2 + F.col("kurt") ** 2 / 4)
    return out.withColumn("jb", jb).withColumn("jb_p", F.exp(-F.col("jb") / 2))


def acf(rows: DataFrame, by: list[str], order: list[str], column: str, lag: int = 1) -> DataFrame:
    """Pearson correlation of the series with itself ``lag`` rows before."""
    shifted = rows.where(F.col(column).isNotNull()).withColumn("_lag", F.lag(column, lag).over(Window.partitionBy(*by).orderBy(*order)))
    return shifted.where("_lag is not null").groupBy(*by).agg(F.corr(column, "_lag").alias("acf"), F.count("*").alias("pairs"))


def ljung_box(rows: DataFrame, by: list[str], order: list[str], column: str, lags: int = 20) -> DataFrame:
    """Statistic and p-value from autocovariances around the series' mean, in one window pass."""
    kept = rows.where(F.col(column).isNotNull())
    kept = kept.withColumn("_c", F.col(column) - F.avg(column).over(Window.partitionBy(*by)))
    w = Window.partitionBy(*by).orderBy(*order)
    kept = kept.select(*by, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = kept.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("_c") ** 2).alias("_v"), *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, lags + 1)])
    n = F.col("n")
    terms = sum((F.pow(safe(F.col(f"_s{k}"), F.col("_v")), 2) / (n - k) for k in range(1, lags + 1)), F.lit(0.0))
    return sums.select(*by, "n", (n * (n + 2) * terms).alias("lb")).withColumn("lb_p", chi2_survival_even(F.col("lb"), lags))


def variance_bins(rows: DataFrame, by: list[str], order: list[str], column: str, bins: int = 10) -> DataFrame:
    """Population variance of equal-count bins in time order; the remainder is left out."""
    kept = rows.where(F.col(column).isNotNull())
    kept = kept.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    kept = kept.withColumn("_size", F.floor(F.count("*").over(Window.partitionBy(*by)) / bins)).where("_size > 0")
    kept = kept.withColumn("bin", F.floor(F.col("_i") / F.col("_size"))).where(F.col("bin") < bins)
    return kept.groupBy(*by, "bin").agg(F.var_pop(column).alias("variance"), F.count("*").alias("rows"))


def levene(rows: DataFrame, by: list[str], order: list[str], column: str, bins: int = 10) -> DataFrame:
    """Median-centred Levene statistic over the bins, its p-value, and the largest to smallest variance ratio."""
    kept = rows.where(F.col(column).isNotNull())
    kept = kept.withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    kept = kept.withColumn("_size", F.floor(F.count("*").over(Window.partitionBy(*by)) / bins)).where("_size > 0")
    kept = kept.withColumn("bin", F.floor(F.col("_i") / F.col("_size"))).where(F.col("bin") < bins)
    centre = kept.groupBy(*by, "bin").agg(F.percentile(column, F.lit(0.5)).alias("_med"))
    dev = kept.join(centre, [*by, "bin"]).withColumn("_z", F.abs(F.col(column) - F.col("_med")))  # ten rows a key
    each = dev.groupBy(*by, "bin").agg(F.count("*").alias("_n"), F.avg("_z").alias("_m"), F.var_pop("_z").alias("_v"), F.var_pop(column).alias("_var"))
    total = each.groupBy(*by).agg(
        F.sum("_n").alias("_N"), F.count("*").alias("_k"), (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("_all"),
        F.sum(F.col("_n") * F.col("_v")).alias("_within"), F.sum(F.col("_n") * F.col("_m") ** 2).alias("_sq"),
        safe(F.max("_var"), F.min("_var")).alias("variance_ratio"),
    )
    between = F.col("_sq") - F.col("_N") * F.col("_all") ** 2
    statistic = safe((F.col("_N") - F.col("_k")) * between, (F.col("_k") - 1) * F.col("_within"))
    out = total.withColumn("levene", statistic)
    return out.select(*by, "levene", f_survival_column(F.col("levene"), F.col("_k") - 1, F.col("_N") - F.col("_k")).alias("levene_p"), "variance_ratio")


def adf_statistic(x: np.ndarray, lags: int = 5) -> tuple[float, float]:
    """Augmented Dickey-Fuller t-statistic with a constant and its 1 % critical value."""
    d = np.diff(x)
    y = d[lags:]
    if len(y) <= lags + 2:
        return float("nan"), float("nan")
    design = np.column_stack([x[lags:-1], *[d[lags - k : len(d) - k] for k in range(1, lags + 1)], np.ones(len(y))])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    left = y - design @ beta
    sigma = left @ left / (len(y) - design.shape[1])
    cov = sigma * np.linalg.pinv(design.T @ design)
    n = len(y)
    if not cov[0, 0] > 0:  # a constant series, or one that the regression fits exactly
        return float("nan"), float("nan")
    return float(beta[0] / np.sqrt(cov[0, 0])), sum(c / n**i for i, c in enumerate(ADF_1PCT))


def _polynomial(coefficients, x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def adf_p_value(stat: float) -> float:
    """Asymptotic p-value of the statistic with a constant."""
    if not np.isfinite(stat):
        return float("nan")
    if stat > ADF_MOST:
        return 1.0
    if stat < ADF_LEAST:
        return 0.0
    return NormalDist().cdf(_polynomial(ADF_LOW_P if stat <= ADF_MIDDLE else ADF_HIGH_P, stat))


def adf_best_lag(x: np.ndarray, most: int | None = None) -> tuple[float, int]:
    """The statistic at the lag with the least AIC, and that lag.

    One orthogonal decomposition serves all lags: over their common sample the
    residual sum of squares falls by the square of ``y``'s part along each new
    direction.
    """
    if most is None:
        most = max(0, min(math.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2))
    d = np.diff(x)
    y = d[most:]
    if len(y) <= most + 2:
        return float("nan"), 0
    design = np.column_stack([np.ones(len(y)), x[most:-1], *[d[most - k : len(d) - k] for k in range(1, most + 1)]])
    along = np.linalg.qr(design)[0].T @ y
    left = np.maximum(y @ y - np.cumsum(along**2), 1e-300)[1:]
    lag = int(np.argmin(len(y) * np.log(left / len(y)) + 2 * np.arange(2, most + 3)))
    return adf_statistic(x, lag)[0], lag


def shapiro_wilk(x: np.ndarray) -> tuple[float, float]:
    """W and its p-value by Royston's approximation; nan for fewer than three values, from ``SHAPIRO_ROWS`` on, and for equal values."""
    n, x = len(x), np.sort(x)
    if n < 3 or n >= SHAPIRO_ROWS or x[0] == x[-1]:
        return float("nan"), float("nan")
    normal = NormalDist()
    m = np.array([normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    total, u = float(m @ m), 1 / math.sqrt(n)
    weights = np.zeros(n)
    if n == 3:
        weights[[0, 2]] = -math.sqrt(0.5), math.sqrt(0.5)
    else:
        ends = [m[-1] / math.sqrt(total) + _polynomial(ROYSTON_LAST, u)]
        if n > 5:
            ends.append(m[-2] / math.sqrt(total) + _polynomial(ROYSTON_SECOND, u))
        k = len(ends)
        scale = (total - 2 * float(m[n - k :] @ m[n - k :])) / (1 - 2 * sum(e * e for e in ends))
        weights = m / math.sqrt(scale)
        for i, e in enumerate(ends):
            weights[n - 1 - i], weights[i] = e, -e
    c = x - x.mean()
    w = min(1.0, float(weights @ x) ** 2 / float(c @ c))
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w == 1.0:
        return w, 1.0
    if n <= 11:
        limit = _polynomial(ROYSTON_FEW[0], n)
        if math.log(1 - w) >= limit:
            return w, 0.0
        y, mean, spread = -math.log(limit - math.log(1 - w)), _polynomial(ROYSTON_FEW[1], n), math.exp(_polynomial(ROYSTON_FEW[2], n))
    else:
        y, mean, spread = math.log(1 - w), _polynomial(ROYSTON_MANY[0], math.log(n)), math.exp(_polynomial(ROYSTON_MANY[1], math.log(n)))
    return w, 1 - normal.cdf((y - mean) / spread)


def _acf_points(x: np.ndarray, points: float) -> float:
    if len(x) < 4 or np.std(x[1:]) == 0 or np.std(x[:-1]) == 0:
        return 0.0
    value, noise = abs(np.corrcoef(x[1:], x[:-1])[0, 1]), 1.96 / np.sqrt(len(x))
    return points if value <= noise else max(0.0, points * (1 - (value - noise) / noise))


def quality_score(returns: np.ndarray, n_ticks: np.ndarray) -> float:
    """Effect-size score of a bar series, at most 90."""
    r = returns[np.isfinite(returns)]
    if len(r) < 14:  # too few for the unit-root test
        return 0.0
    score = _acf_points(r, 20.0) + _acf_points(r**2, 20.0)
    size = len(r) // 10
    spread = r[: size * 10].reshape(10, size).var(axis=1)
    if spread.min() > 0:
        score += max(0.0, 20.0 * (1 - np.log10(spread.max() / spread.min())))
    stat, critical = adf_statistic(r)
    if np.isfinite(stat):
        score += 10.0 if stat <= critical else 10.0 * (1 - min(1.0, max(0.0, (stat - critical) / -critical)))
    cv = n_ticks.std() / n_ticks.mean() if n_ticks.mean() > 0 else 2.0
    score += max(0.0, 10.0 * (1 - min(cv, 1.0)))
    c = r - r.mean()
    var = (c**2).mean()
    tails = abs((c**3).mean() / var**1.5) + abs((c**4).mean() / var**2 - 3) if var > 0 else 5.0
    return float(score + max(0.0, 10.0 * (1 - tails / 5.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + top / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return out


def f_survival(f: float, d1: float, d2: float) -> float:
    """P(F > f) with ``d1`` and ``d2`` degrees of freedom."""
    if not f > 0:
        return 1.0
    a, b, x = d2 / 2, d1 / 2, d2 / (d2 + d1 * f)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def lgamma_column(x: Column) -> Column:
    """Logarithm of the gamma function for positive ``x``: Stirling's series after ten steps of the recurrence."""
    z = x + 10
    series = (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3.0))) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    return series - sum((F.ln(x + i) for i in range(1, 10)), F.ln(x))


def f_survival_column(f: Column, d1: Column, d2: Column, steps: int = 300) -> Column:
    """P(F > f) as a column: the incomplete beta function by its continued fraction (modified Lentz)."""
    f, d1, d2 = f.cast("double"), d1.cast("double"), d2.cast("double")
    tiny = lambda v: F.when(F.abs(v) < 1e-300, 1e-300).otherwise(v)

    def fraction(a: Column, b: Column, x: Column) -> Column:
        def step(s: Column, m: Column) -> Column:
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d = 1 / tiny(1 + even * s["d"])
            c = tiny(1 + even / s["c"])
            return F.struct(tiny(1 + odd / c).alias("c"), (1 / tiny(1 + odd * d)).alias("d"), (s["out"] * c * d).alias("half"))

        def whole(s: Column, m: Column) -> Column:
            t = step(s, m.cast("double"))
            return F.struct(t["c"].alias("c"), t["d"].alias("d"), (t["half"] * t["c"] * t["d"]).alias("out"))

        first = 1 / tiny(1 - (a + b) * x / (a + 1))
        start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, whole)["out"]

    a, b, x = d2 / 2, d1 / 2, d2 / (d2 + d1 * f)
    front = F.exp(a * F.ln(x) + b * F.ln(1 - x) - (lgamma_column(a) + lgamma_column(b) - lgamma_column(a + b)))
    near = x < (a + 1) / (a + b + 2)
    value = F.when(near, front * fraction(a, b, x) / a).otherwise(1 - front * fraction(b, a, 1 - x) / b)
    return F.when(f.isNull() | (d1 < 1) | (d2 < 1), None).when(f > 0, value).otherwise(1.0)


def legacy_quality_score(returns: np.ndarray, n_ticks: np.ndarray, most: int | None = None) -> float:
    """The older score of at most 100 points, from p-values; ``most``: the longest lag of the unit-root test."""
    r = returns[np.isfinite(returns)]
    if len(r) < 30:
        return 0.0
    acf1 = abs(np.corrcoef(r[1:], r[:-1])[0, 1])
    stationary = adf_p_value(adf_best_lag(r, most)[0]) < 0.05
    size = len(r) // 10
    dev = r[: size * 10].reshape(10, size)
    dev = np.abs(dev - np.median(dev, axis=1, keepdims=True))
    n, within = dev.size, ((dev - dev.mean(axis=1, keepdims=True)) ** 2).sum()
    between = size * ((dev.mean(axis=1) - dev.mean()) ** 2).sum()
    levene_p = f_survival((n - 10) * between / (9 * within), 9, n - 10) if within > 0 else 0.0
    c = r - r.mean()
    var = (c**2).mean()
    jb = len(r) / 6 * (((c**3).mean() / var**1.5) ** 2 + ((c**4).mean() / var**2 - 3) ** 2 / 4)
    cv = n_ticks.std() / n_ticks.mean() if n_ticks.mean() > 0 else 2.0
    return float(max(0, 30 * (1 - acf1)) + (25 if stationary else 0) + min(20, 20 * levene_p) + max(0, 15 * (1 - min(cv, 1))) + min(10, 10 * math.exp(-jb / 2)))


def adf(rows: DataFrame, by: list[str], order: list[str], column: str, lags: int | None = 5, most: int | None = None) -> DataFrame:
    """Statistic, lag, p-value and critical values per key, over bars (not ticks): a group is one symbol's bars.  ``lags`` None: by AIC, up to ``most``."""
    kinds = dict(rows.dtypes)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf.sort_values(order)[column].dropna().to_numpy()
        stat, used = (adf_statistic(x, lags)[0], lags) if lags is not None else adf_best_lag(x, most)
        n = len(x) - 1 - used
        critical = [_polynomial(t, 1 / n) if np.isfinite(stat) else float("nan") for t in (ADF_1PCT, ADF_5PCT)]
        return pd.DataFrame([[*key, len(x), stat, used, adf_p_value(stat), *critical]])

    ddl = ", ".join(f"{c} {kinds[c]}" for c in by) + ", n long, adf double, lag int, adf_p double, adf_crit_1pct double, adf_crit_5pct double"
    return rows.select(*by, *order, column).groupBy(*by).applyInPandas(run, ddl)


def shapiro(rows: DataFrame, by: list[str], column: str) -> DataFrame:
    """W and p-value per key; null from ``SHAPIRO_ROWS`` values on, whose rows never meet in one task."""
    kinds = dict(rows.dtypes)
    kept = rows.where(F.col(column).isNotNull() & ~F.isnan(column)).select(*by, column)
    sizes = kept.groupBy(*by).agg(F.count("*").alias("n"))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[*key, *shapiro_wilk(pdf[column].to_numpy())]])

    small = kept.join(sizes.where(F.col("n") < SHAPIRO_ROWS).select(*by), by, "left_semi")
    ddl = ", ".join(f"{c} {kinds[c]}" for c in by) + ", w double, w_p double"
    found = small.groupBy(*by).applyInPandas(run, ddl)
    return sizes.join(found, by, "left").select(*by, "n", F.nanvl("w", F.lit(None)).alias("shapiro_w"), F.nanvl("w_p", F.lit(None)).alias("shapiro_p"))


def quality_scores(bars: DataFrame, by: list[str], order: list[str], score=quality_score) -> DataFrame:
    """Score per key from ``log_return`` and ``n_ticks``."""
    kinds = dict(bars.dtypes)

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pd.DataFrame([[*key, len(pdf), score(pdf["log_return"].to_numpy(dtype=float), pdf["n_ticks"].to_numpy(dtype=float))]])

    ddl = ", ".join(f"{c} {kinds[c]}" for c in by) + ", bars long, quality_score double"
    return bars.select(*by, *order, "log_return", "n_ticks").groupBy(*by).applyInPandas(run, ddl)


def sampling_efficiency(bars: DataFrame, by: list[str]) -> DataFrame:
    q = lambda p: F.percentile("n_ticks", F.lit(p))
    return bars.groupBy(*by).agg(
        F.avg("n_ticks").alias("mean_ticks"), F.stddev_pop("n_ticks").alias("std_ticks"), safe(F.stddev_pop("n_ticks"), F.avg("n_ticks")).alias("cv_ticks"),
        F.min("n_ticks").alias("min_ticks"), F.max("n_ticks").alias("max_ticks"), q(0.5).alias("median_ticks"), (q(0.75) - q(0.25)).alias("iqr_ticks"),
    )


def bar_metrics(bars: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Count, mean and spread of returns, Sharpe ratio, maximum drawdown, activity; needs ``log_return``."""
    from barloom.operators.features import drawdown

    curve = drawdown(bars.where("log_return is not null"), by, order)
    out = curve.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg("log_return").alias("mean_return"), F.stddev_samp("log_return").alias("std_return"),
        F.min("drawdown").alias("max_drawdown"), F.sum("volume").alias("volume"), F.sum("dollar").alias("dollar"),
    )
    return out.withColumn("sharpe", F.coalesce(safe(F.col("mean_return"), F.col("std_return")) * (252**0.5), F.lit(0.0)))


def variance_over_bins(rows: DataFrame, by: list[str], order: list[str], column: str, bins: int = 10) -> DataFrame:
    """``variance_over_bins``: sample variance of the whole series over the mean of its bins'."""
    size = F.col("rows")
    inner = variance_bins(rows, by, order, column, bins).groupBy(*by).agg(F.avg(F.col("variance") * size / F.nullif(size - 1, F.lit(0))).alias("_inner"))
    outer = rows.groupBy(*by).agg(F.var_samp(column).alias("_outer"))
    return outer.join(inner, by).select(*by, safe(F.col("_outer"), F.col("_inner")).alias("variance_over_bins"))


def all_statistics(bars: DataFrame, by: list[str], order: list[str], lags: int = 20, most: int | None = None) -> DataFrame:
    """Every statistic of a set of bars, a row a key: metrics, moments and tests of the returns, sampling, and the older score.

    Each test is a pass over the bars (write them once if they are costly to
    make); what is joined has a row a key.  Statistics that a short series does
    not have are null.  ``most``: the longest lag of the unit-root test.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    rows = bars.withColumn("log_return", F.ln(F.col("close") / F.lag("close").over(w)))
    series = (rows, by, order, "log_return")
    parts = [
        bar_metrics(rows, by, order).drop("n"),
        moments(rows, by, "log_return").select(*by, "skew", "kurt", "jb", "jb_p"),
        shapiro(rows, by, "log_return").drop("n"),
        ljung_box(*series, lags).select(*by, "lb", "lb_p"),
        acf(*series).select(*by, F.col("acf").alias("acf_lag1"), F.abs("acf").alias("abs_acf_lag1")),
        adf(*series, None, most).drop("n").withColumn("is_stationary", F.col("adf_p") < 0.05),
        levene(*series), variance_over_bins(*series), sampling_efficiency(rows, by),
        quality_scores(rows, by, order, partial(legacy_quality_score, most=most)).select(*by, "quality_score"),
    ]
    out = rows.groupBy(*by).agg(F.count("*").alias("n_bars"))
    for part in parts:
        out = out.join(part, by, "left")
    return out
