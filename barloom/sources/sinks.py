"""Idempotent writes: staged publication, replace-window, upsert, append of missing days, rotation."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all machines share (``spark.checkpoint.dir``); a local session without it gets one under ``/tmp``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and (held := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        root = held.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to a new shared folder and read back: computed once however many plans read it."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def publish(frame: DataFrame, path: str, check: Callable[[DataFrame], list[str]], partition_by: list[str] | None = None) -> None:
    """Check, write beside the target, read back, check again, then rename; the old target survives any failure."""
    spark = frame.sparkSession
    if errors := check(frame):
        raise ValueError(f"not published: {errors}")
    staged, old = f"{path}.staged", f"{path}.old"
    writer = frame.write.mode("overwrite")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
        if errors := check(spark.read.schema(frame.schema).parquet(staged)):
            raise ValueError(f"not published after reading back: {errors}")
    except BaseException:
        remove(spark, staged)
        raise
    fs, target = _fs(spark, path)
    _, stage_at = _fs(spark, staged)
    _, old_at = _fs(spark, old)
    fs.delete(old_at, True)
    if fs.exists(target):
        fs.rename(target, old_at)
    if not fs.rename(stage_at, target):
        fs.rename(old_at, target)
        raise OSError(f"cannot rename {staged}")
    fs.delete(old_at, True)


def replace_days(frame: DataFrame, path: str, keys: tuple[str, ...] = ("symbol", "day")) -> None:
    """Replaces whole partitions that the frame has and leaves the others; running twice changes nothing."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_missing_days(frame: DataFrame, path: str, keys: tuple[str, ...] = ("symbol", "day")) -> None:
    spark = frame.sparkSession
    if exists(spark, path):
        frame = frame.join(spark.read.schema(frame.schema).parquet(path).select(*keys).distinct(), list(keys), "left_anti")
    frame.write.mode("append").partitionBy(*keys).parquet(path)


def replace_window(old: DataFrame, new: DataFrame, time: str = "open_time") -> DataFrame:
    """Old rows outside each symbol's new ``[min, max]``, and the new rows."""
    span = new.groupBy("symbol").agg(F.min(time).alias("_lo"), F.max(time).alias("_hi"))  # a row a symbol
    kept = old.join(span, "symbol", "left").where(F.col("_lo").isNull() | (F.col(time) < F.col("_lo")) | (F.col(time) > F.col("_hi")))
    return kept.select(old.columns).unionByName(new)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows win over old ones of the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def insert_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is already there are left out."""
    return old.unionByName(new.join(old.select(*key).distinct(), key, "left_anti"))


def replace_and_rotate(old: DataFrame, new: DataFrame, keep: int = 300) -> DataFrame:
    """New days replace old ones; the last ``keep`` bars of each symbol stay."""
    merged = old.join(new.select("symbol", "day").distinct(), ["symbol", "day"], "left_anti").unionByName(new)
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("open_time"), F.desc("close_time")))
    return merged.withColumn("_r", rank).where(F.col("_r") <= keep).drop("_r")


def dataset_name(symbol: str, year: int, months: list[int] | None = None) -> str:
    """Runs over some months never take the annual name."""
    return f"{symbol}_{year}" + (f"_months_{'_'.join(f'{m:02d}' for m in months)}" if months else "")


def write_daily_files(bars: DataFrame, path: str, interval: str | None = None, time: str = "open_time") -> None:
    """A folder a symbol and date (and interval); days that are already there are left as they are."""
    keys = ("symbol", "interval", "date") if interval else ("symbol", "date")
    dated = bars.withColumn("date", F.to_date(time))
    append_missing_days(dated.withColumn("interval", F.lit(interval)) if interval else dated, path, keys)


def write_report(report: DataFrame, path: str, kind: str = "csv") -> None:
    """A report, a row a day or a study, as one CSV, JSON-lines or text file that replaces an older one.

    In a text file a row is a paragraph of ``name: value`` lines, nulls empty.
    """
    writer = report.coalesce(1).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif kind == "text":
        lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in report.columns]
        report.select(F.concat(F.concat_ws("\n", *lines), F.lit("\n")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    else:
        raise ValueError(f"no writer for {kind}")
