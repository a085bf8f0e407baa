"""Winsorizing with global, fitted and strictly prior bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys of at most so many rows get exact quantiles of their history, in one task each; larger ones get sketches.
EXACT_ROWS = 100_000
#: Size of a sketch: a quantile of a larger key is off by at most 2.296 / SKETCH_K ** 0.9433 of its rank (0.05 % at 8192) in 99 of 100 cases.
SKETCH_K = 8192


def _clip(c: str, lo: Column, hi: Column) -> Column:
    clipped = F.when(F.col(c).isNull(), None).when(lo.isNull(), F.col(c)).otherwise(F.greatest(lo, F.least(hi, F.col(c))))
    return clipped.alias(c)


def fit(rows: DataFrame, columns: list[str], by: list[str] | None = None, lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Exact bounds ``lo_c, hi_c``: one row, or one for each key."""
    bounds = [F.percentile(c, F.lit(p)).alias(f"{n}_{c}") for c in columns for n, p in (("lo", lower), ("hi", upper))]
    return rows.groupBy(*(by or [])).agg(*bounds)


def transform(rows: DataFrame, bounds: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Columns without bounds (all null when fitted) and columns not named pass unchanged."""
    joined = rows.join(bounds, by, "left") if by else rows.crossJoin(F.broadcast(bounds))  # one row without keys
    return joined.select(*[_clip(c, F.col(f"lo_{c}"), F.col(f"hi_{c}")) if c in columns else F.col(c) for c in rows.columns])


def clip_global(rows: DataFrame, columns: list[str], by: tuple[str, ...] = ("symbol",), lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Bounds from all rows: looks ahead; for comparison only."""
    return transform(rows, fit(rows, columns, list(by), lower, upper), columns, list(by))


def _known(c: str) -> Column:
    """A column as the history sees it: NaN is nothing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _sketched_bounds(sketches: DataFrame, columns: list[str], period: str, keys: list[str], lower: float, upper: float, k: int) -> DataFrame:
    """Bounds of each period from sketches of the periods before, merged over a running window of a row a period."""
    before = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    merged = sketches.select(*keys, period, *[F.kll_merge_agg_double(f"_s_{c}", k).over(before).alias(f"_s_{c}") for c in columns])
    at = lambda c, p: F.when(F.kll_sketch_get_n_double(f"_s_{c}") > 0, F.kll_sketch_get_quantile_double(f"_s_{c}", F.lit(float(p))))
    return merged.select(*keys, period, *[at(c, p).alias(f"{n}_{c}") for c in columns for n, p in (("lo", lower), ("hi", upper))])


def _exact_bounds(rows: DataFrame, columns: list[str], period: str, keys: list[str], lower: float, upper: float) -> DataFrame:
    """The same from the values themselves, all columns of a key at once; for keys of bounded size."""
    kinds = dict(rows.dtypes)

    def run(own: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(period, kind="stable")
        values = {c: pdf[c].to_numpy(dtype=float) for c in columns}
        firsts = pdf[period].to_numpy()
        starts = [0, *(np.flatnonzero(firsts[1:] != firsts[:-1]) + 1)]
        out = []
        for at in starts:
            row = [*own, firsts[at]]
            for c in columns:
                history = values[c][:at]
                history = history[~np.isnan(history)]
                row += np.quantile(history, [lower, upper]).tolist() if len(history) else [None, None]
            out.append(row)
        return pd.DataFrame(out)

    ddl = ", ".join(f"{c} {kinds[c]}" for c in [*keys, period]) + "".join(f", {n}_{c} double" for c in columns for n in ("lo", "hi"))
    return rows.select(*keys, period, *[_known(c).alias(c) for c in columns]).groupBy(*keys).applyInPandas(run, ddl)


def accumulated_bounds(
    rows: DataFrame, columns: list[str], period: str, by: tuple[str, ...] = ("symbol",), lower: float = 0.01, upper: float = 0.99,
    exact_rows: int = EXACT_ROWS, k: int = SKETCH_K,
) -> DataFrame:
    """``by, period`` and ``lo_c, hi_c`` of every column, from all strictly earlier periods; null without any value there.

    One pass sketches all columns of every key and period; sketches are
    merged from period to period, so no value is read again for a later one.
    Keys of at most ``exact_rows`` rows get exact (interpolated) quantiles
    instead; the others the value at the rank, off by what ``SKETCH_K`` says.
    """
    keys = list(by)
    kept = rows.dropna(subset=[*keys, period])
    sketches = kept.groupBy(*keys, period).agg(F.count("*").alias("_n"), *[F.kll_sketch_agg_double(_known(c), k).alias(f"_s_{c}") for c in columns])
    sized = sketches.withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))  # a row a period
    large = _sketched_bounds(sized.where(F.col("_all") > exact_rows), columns, period, keys, lower, upper, k)
    counts = kept.groupBy(*keys).agg(F.count("*").alias("_all"))
    small = kept.join(counts.where(F.col("_all") <= exact_rows).select(*keys), keys, "left_semi")
    return large.unionByName(_exact_bounds(small, columns, period, keys, lower, upper))


def clip_accumulating(
    rows: DataFrame, columns: list[str], period: str, by: tuple[str, ...] = ("symbol",), lower: float = 0.01, upper: float = 0.99, exact_rows: int = EXACT_ROWS, k: int = SKETCH_K
) -> DataFrame:
    """Bounds of a period come from the unclipped values of all strictly earlier periods; the first passes unchanged, as do rows without a key or period."""
    bounds = accumulated_bounds(rows, columns, period, by, lower, upper, exact_rows, k)
    return transform(rows, bounds, columns, [*by, period])


def fit_on_context(rows: DataFrame, columns: list[str], is_context: Column, by: tuple[str, ...] = ("symbol",), lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Bounds from the context rows clip all rows; the rows after the context are returned."""
    bounds = fit(rows.where(is_context), columns, list(by), lower, upper)
    return transform(rows, bounds, columns, list(by)).where(~is_context)
