"""Line deduplication by the number of distinct sites a line stands on.

A HyperLogLog sketch of the sites is built for every line hash; sketches merge
by aggregation, on the map side first, so a line that every document carries
costs a row a task.  Lines whose estimate lies within the sketch's error of the
limit are counted exactly; the rest are decided by the estimate.  Lines on
``min_sites`` distinct sites or more are boilerplate and are removed everywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import SPACE_CLASS, cut

#: log2 of a sketch's registers; the relative standard error is 1.04 / 2 ** (LG_K / 2).
LG_K = 12


def normalised_line(line: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS + "+", " "))


def _hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Hashes ``line`` on ``min_sites`` or more distinct sites, from ``(line, site)``."""
    sketched = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("estimate"))
    margin = max(2, math.ceil(5 * 1.04 / 2 ** (LG_K / 2) * min_sites))
    judged = cut(sketched.where(F.col("estimate") >= min_sites - margin))
    near = judged.where(F.col("estimate") <= min_sites + margin).select("line")
    # Distinct pairs before the join: a hot line is then as many rows as it has sites.
    exact = lines.distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    sure = judged.where(F.col("estimate") > min_sites + margin).select("line")
    return sure.unionByName(exact.select("line"))


def remove_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = 10
) -> DataFrame:
    """One row per input row: ``id_col, text, n_lines, n_removed, clean_text``.

    Lines are the parts between line feeds; those without a word are never
    removed.  Null texts stay null and have no lines; an empty text is one
    line.  A null site is a site of its own.  Repeated rows get equal results;
    an empty table gives none; other columns are ignored, whatever their names.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"), F.xxhash64(F.lit("second"), F.coalesce(text, F.lit(""))).alias("k2"),
        F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("null")).alias("site"),
    )
    lines = rows.select("k1", "k2", "site", F.explode(F.split("text", "\n")).alias("raw")).where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))
    lines = lines.select("k1", "k2", "site", _hash(F.col("raw")).alias("line"))
    bad = cut(boilerplate_lines(lines.select("line", "site"), min_sites))
    struck = lines.select("k1", "k2", "line").join(bad, "line").groupBy("k1", "k2").agg(F.collect_set("line").alias("struck"))
    joined = rows.alias("r").join(struck.alias("s"), (F.col("r.k1") == F.col("s.k1")) & (F.col("r.k2") == F.col("s.k2")), "left")
    all_lines = F.split("text", "\n")
    left = F.when(F.col("struck").isNull(), all_lines).otherwise(
        F.filter(all_lines, lambda x: ~(F.array_contains(F.col("struck"), _hash(x)) & x.rlike(r"[^\x20\x09-\x0D]")))
    )
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(all_lines)).cast("long")
    n_left = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(left)).cast("long")
    return joined.select(
        F.col("id").alias(id_col), F.col("text"), n_lines.alias("n_lines"), (n_lines - n_left).alias("n_removed"), F.array_join(left, "\n").alias("clean_text")
    )
