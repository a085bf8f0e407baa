"""Long keys in pieces: runs of consecutive time buckets of one key, each a task's work.

A window over a key holds the whole key in one task.  Where what a row needs
from before is bounded (a halo of rows) or a single value (the last one), the
key can be cut into pieces: every piece gets the halo rows of the one before,
and the value that all earlier pieces end with, as a row in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.sources import sinks


def bucket_of(time: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds)


def cut_keys(rows: DataFrame, keys: list[str], time: str, piece_rows: int, seconds: int) -> DataFrame:
    """``keys, _bucket, _piece``: consecutive buckets of a key are joined until they have ``piece_rows`` rows.

    So every piece but a key's last has at least that many.  A bucket is never
    cut: ``seconds`` bounds what one instant can bring.  The table has a row
    for each bucket of a key and is written once, as several plans read it.
    """
    counts = rows.groupBy(*keys, bucket_of(time, seconds).alias("_bucket")).agg(F.count("*").alias("_n"))
    ordered = F.array_sort(F.collect_list(F.struct("_bucket", "_n")))
    start = F.expr("named_struct('piece', 0L, 'held', 0L, 'out', cast(array() as array<struct<_bucket:bigint,_piece:bigint>>))")

    def take(s: Column, b: Column) -> Column:
        full = s["held"] >= piece_rows
        piece = F.when(full, s["piece"] + 1).otherwise(s["piece"])
        return F.struct(piece.alias("piece"), (F.when(full, 0).otherwise(s["held"]) + b["_n"]).cast("long").alias("held"), F.concat(s["out"], F.array(F.struct(b["_bucket"].alias("_bucket"), piece.alias("_piece")))).alias("out"))

    cut = counts.groupBy(*keys).agg(F.aggregate(ordered, start, take)["out"].alias("_cut"))
    table = cut.select(*keys, F.explode("_cut").alias("_c")).select(*keys, "_c._bucket", "_c._piece")
    return sinks.kept(table, "pieces")


def in_pieces(rows: DataFrame, table: DataFrame, keys: list[str], time: str, seconds: int) -> DataFrame:
    """Rows with their ``_piece``; those with a null key or time have none and go."""
    return rows.withColumn("_bucket", bucket_of(time, seconds)).join(table, [*keys, "_bucket"]).drop("_bucket")


def last_rows(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The last ``n`` rows of every piece, for the piece after it; only so many a task are shuffled."""
    w = Window.partitionBy(*keys, "_piece").orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r").withColumn("_piece", F.col("_piece") + 1)


def carried_in(ends: DataFrame, table: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, _piece, value``: the last value that is not null in the pieces before; over a row a piece."""
    pieces = table.select(*keys, "_piece").distinct().join(ends, [*keys, "_piece"], "left")
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(*keys, "_piece", F.last(value, ignorenulls=True).over(before).alias(value)).where(F.col(value).isNotNull())
