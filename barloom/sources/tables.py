"""Tick, funding and store scans.

Ticks have ``symbol, id, ts, price, quantity, is_buyer_maker``; ``(ts, id)`` is
their total order.  ``ts`` is a time without zone and means UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_TRADE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("quote_qty", T.DoubleType()),
        T.StructField("time", T.LongType()),
        T.StructField("is_buyer_maker", T.StringType()),
        T.StructField("is_best_match", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tick view of ``events``: one projection, so filters and columns still reach the scan."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("id"), F.col("ts"), F.col("value").alias("price"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("quantity"), (F.col("user_id") % 2 == 0).alias("is_buyer_maker"),
    )


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with repeated rows and rows of negative or undefined price, for deduplication and audits."""
    base = ticks(spark, sf_dir)
    again = base.where("id % 97 = 0")
    negative = base.where("id % 101 = 0").withColumn("price", -F.col("price")).withColumn("id", F.col("id") + 10_000_000)
    undefined = base.where("id % 103 = 0").withColumn("price", F.lit(float("nan"))).withColumn("id", F.col("id") + 20_000_000)
    return base.unionByName(again).unionByName(negative).unionByName(undefined)


def spiky_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    spiked = F.when(F.col("id") % 251 == 0, F.col("price") * 1000).otherwise(F.col("price"))
    return ticks(spark, sf_dir).withColumn("price", spiked)


def funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight-hour funding series per symbol; a rate is known from the end of its bucket."""
    bucket = F.window("ts", "8 hours")
    rates = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), bucket.alias("w"))
    return rates.agg(((F.avg("value") - 50) / 1e4).alias("funding_rate")).select("symbol", F.col("w.end").alias("funding_time"), "funding_rate")


def epoch_to_ts(epoch: Column) -> Column:
    """Exchange epochs are microseconds above 1e14, milliseconds else.

    Each value tells by itself: as milliseconds 1e14 is the year 5138, as
    microseconds it is March 1973, so no largest value of a file or frame is needed.
    """
    return F.timestamp_micros(F.when(epoch > 10**14, epoch).otherwise(epoch * 1000)).cast("timestamp_ntz")


def normalise_times(rows: DataFrame, column: str = "ts") -> DataFrame:
    """Numbers are epochs, times with zone become UTC, others already are; in one pass."""
    if column not in rows.columns:
        raise ValueError(f"missing time column: {column}")
    kind = dict(rows.dtypes)[column]
    if kind in ("bigint", "int", "double", "float"):
        return rows.withColumn(column, epoch_to_ts(F.col(column).cast("long")))
    return rows.withColumn(column, F.to_timestamp_ntz(F.col(column)) if kind == "string" else F.col(column).cast("timestamp_ntz"))


def bars_between(store: DataFrame, symbol: str, first: str, last: str) -> DataFrame:
    """Bars of a symbol, both ends included."""
    return store.where((F.col("symbol") == symbol) & F.col("open_time").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))


def bars_of_year(store: DataFrame, symbol: str, year: int) -> DataFrame:
    """Bars of a year, the next year's first instant excluded."""
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return store.where((F.col("symbol") == symbol) & (F.col("open_time") >= start) & (F.col("open_time") < end))


def of_period(store: DataFrame, symbol: str | None = None, period: str | None = None) -> DataFrame:
    """Rows of a store keyed by symbol and period (studies, failed days, summaries); None is any."""
    for column, wanted in (("symbol", symbol), ("period", period)):
        if wanted is not None:
            store = store.where(F.col(column) == wanted)
    return store


def positioning_between(store: DataFrame, symbol: str, first: str, last: str) -> DataFrame:
    """Positioning of a symbol by funding time, both ends included."""
    return store.where((F.col("symbol") == symbol) & F.col("funding_time").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))


def available_datasets(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """``(symbol, year)`` of every annual dataset ``path/<year>/<symbol>_<year>.parquet``, in order.

    Datasets over some months and reports are left out.  Only names are listed, through Hadoop's file system.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for folder in fs.listStatus(hadoop) if fs.exists(hadoop) else []:
        if not (folder.isDirectory() and folder.getPath().getName().isdigit()):
            continue
        for entry in fs.listStatus(folder.getPath()):
            symbol, _, year = entry.getPath().getName().removesuffix(".parquet").rpartition("_")
            if entry.getPath().getName().endswith(".parquet") and symbol and year.isdigit() and "_months" not in symbol:
                found.append((folder.getPath().getName(), symbol, int(year)))
    return [(symbol, year) for _, symbol, year in sorted(found)]


def decoded(line: Column) -> Column:
    """A line of bytes as text: UTF-8, or Latin-1 where it is not that; without a byte-order mark."""
    text = F.when(F.is_valid_utf8(line), line).otherwise(F.decode(line.cast("binary"), "ISO-8859-1"))
    return F.regexp_replace(text, "^(\ufeff|\u00ef\u00bb\u00bf)", "")


def read_trade_csv(spark: SparkSession, path: str) -> DataFrame:
    """Exchange trade files: typed columns, in one scan that splits large files.

    Files may differ in charset and in the unit of their times.  A header
    line, or any other without a numeric time, drops out.
    """
    options = {"mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TRADE)
    rows = spark.read.text(path).select(F.from_csv(decoded(F.col("value")), ddl, options).alias("r")).select("r.*").where("time is not null")
    at = epoch_to_ts(F.col("time"))
    return rows.select(
        "id", at.alias("ts"), "price", F.col("qty").alias("quantity"),
        (F.lower(F.trim("is_buyer_maker")) == "true").alias("is_buyer_maker"), F.date_format(at, "yyyy-MM-dd").alias("download_date"),
    )


def read_ticks(spark: SparkSession, path: str, symbol: str | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
    """A tick store partitioned by symbol and download_date; the conditions prune partitions."""
    rows = spark.read.parquet(path)
    if symbol is not None:
        rows = rows.where(F.col("symbol") == symbol)
    if first is not None:
        rows = rows.where(F.col("download_date") >= first)
    return rows if last is None else rows.where(F.col("download_date") <= last)


def read_funding_files(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Cached funding files (``symbol, funding_time, funding_rate``): one row a symbol and time, as months overlap at their ends; of several the least rate.

    Times, both ends included, reach the scan.
    """
    rows = spark.read.parquet(path)
    for bound, op in ((first, ">="), (last, "<=")):
        if bound is not None:
            at = F.lit(bound).cast("timestamp_ntz")
            rows = rows.where(F.col("funding_time") >= at if op == ">=" else F.col("funding_time") <= at)
    return rows.where("funding_time is not null").groupBy("symbol", "funding_time").agg(F.min("funding_rate").alias("funding_rate"))


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """Days of a tick store: partition values only."""
    return spark.read.parquet(path).select("symbol", "download_date").distinct()


def read_dated_files(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """Parquet files whose names carry a date in ``[first, last]``."""
    day = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1)
    return spark.read.parquet(path).where((day >= first) & (day <= last))


def synthetic_ticks(spark: SparkSession, n: int = 300_000, seed: int = 42, symbol: str = "SYN", block: int = 100_000) -> DataFrame:
    """A random walk on a 100 ms grid with log-normal quantities.

    The walk adds up in two levels, within blocks of ids and over the blocks' sums, so that no task holds more than a block.
    """
    rows = spark.range(n).select("id", F.randn(seed).alias("move"), F.randn(seed + 1).alias("size")).withColumn("_block", F.floor(F.col("id") / block))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_block").agg(F.sum("move").alias("_sum")).select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0.0)).alias("_start"))  # a row a block
    within = Window.partitionBy("_block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    walked = rows.withColumn("_own", F.sum("move").over(within)).join(starts, "_block")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return walked.select(
        F.lit(symbol).alias("symbol"), "id", (start + F.make_dt_interval(secs=F.col("id") * 0.1)).alias("ts"),
        F.greatest(F.lit(1.0), 40_000 + 2 * (F.col("_start") + F.col("_own"))).alias("price"), F.exp(-0.1 + 0.35 * F.col("size")).alias("quantity"),
        (F.col("size") > 0).alias("is_buyer_maker"),
    )


def parse_study_reports(spark: SparkSession, path: str) -> DataFrame:
    """Studies from text reports in folders named ``bayesian_YYYY_MM_w2m``."""
    rows = spark.read.text(path, wholetext=True).withColumn("file", F.input_file_name())
    number = r"([0-9.eE+-]+)"
    return rows.select(
        F.concat_ws("-", F.regexp_extract("file", r"bayesian_(\d{4})_(\d{2})_w2m", 1), F.regexp_extract("file", r"bayesian_(\d{4})_(\d{2})_w2m", 2)).alias("period"),
        F.regexp_extract("value", rf"exp_lambda:\s*{number}", 1).cast("double").alias("exp_lambda"),
        F.regexp_extract("value", rf"init_exp_T:\s*{number}", 1).cast("double").alias("init_exp_t"),
        F.regexp_extract("value", rf"Completion Rate:\s*{number}", 1).cast("double").alias("completion_pct"),
        F.regexp_extract_all("value", F.lit(r"DATE:\s*(\d{4}-\d{2}-\d{2})"), F.lit(1)).alias("failed_dates"),
    ).where("period <> ''").orderBy("period")


def parse_failed_days(spark: SparkSession, path: str) -> DataFrame:
    """Failed days of text analyses: ``file, period, failed_date, trials, insufficient_bars, errors, details``, a row for each ``DATE:`` paragraph."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    paragraphs = rows.select("file", F.regexp_extract("value", r"(?m)^Period:\s*(\d{4}-\d{2})", 1).alias("period"), F.explode(F.regexp_extract_all("value", F.lit(r"(?ms)^DATE:.*?(?=^DATE:|^=|\z)"), F.lit(0))).alias("p"))
    whole = lambda pattern: F.regexp_extract("p", pattern, 1).try_cast("int")
    details = F.regexp_extract("p", r"(?m)^\s*Details:[ \t]*(.*?)\s*$", 1)
    return paragraphs.select(
        "file", "period", F.regexp_extract("p", r"^DATE:\s*(\S+)", 1).alias("failed_date"), whole(r"Failed (\d+) times").alias("trials"),
        whole(r"Insufficient bars:\s*(\d+)").alias("insufficient_bars"), whole(r"Errors:\s*(\d+)").alias("errors"),
        F.when(details != "", F.split(details, r",\s*")).otherwise(F.array().cast("array<string>")).alias("details"),
    )
