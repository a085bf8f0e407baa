"""As-of, strict as-of and band joins without a Cartesian product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import pieces

#: Seconds of a time bucket where a key is cut into pieces.
PIECE_SECONDS = 600


def asof_backward(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], values: list[str], strict: bool = False, piece_rows: int | None = None
) -> DataFrame:
    """Every left row with the right values of the latest ``right_on <= left_on`` (``<`` when strict).

    One union and one window: rows of the right side sort before (after, when
    strict) left rows of the same time, and the last value is carried on.  The
    cost is a single shuffle of both sides, whatever the density of the right one.

    With ``piece_rows`` (times only) a key is cut into pieces of about so many
    rows; each piece's last right row is carried over a small table into the
    next ones.  Left rows with a null key or time come back without values.
    """
    types = dict(left.dtypes) | {v: t for v, t in right.dtypes if v in values}
    side_l, side_r = (0, 1) if strict else (1, 0)
    packed = F.struct(*[F.col(v) for v in values])
    none = F.lit(None).cast("struct<" + ",".join(f"`{v}`:{types[v]}" for v in values) + ">")
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    a = left.select(*by, F.col(left_on).alias("_at"), F.lit(side_l).alias("_side"), row.alias("_row"), none.alias("_value"))
    no_row = F.lit(None).cast(a.schema["_row"].dataType)
    b = right.select(*by, F.col(right_on).alias("_at"), F.lit(side_r).alias("_side"), no_row.alias("_row"), packed.alias("_value"))
    keys = by
    if piece_rows is None:
        both = a.unionByName(b)
    else:
        whole = [*by, "_at"]
        table = pieces.cut_keys(a.select(*whole).unionByName(b.select(*whole)).dropna(), by, "_at", piece_rows, PIECE_SECONDS)
        placed = pieces.in_pieces(b, table, by, "_at", PIECE_SECONDS)
        ends = placed.groupBy(*by, "_piece").agg(F.max_by("_value", "_at").alias("_value"))  # a row a piece
        heads = pieces.carried_in(ends, table, by, "_value").select(*by, F.lit(None).cast(types[left_on]).alias("_at"), F.lit(-1).alias("_side"), no_row.alias("_row"), "_value", "_piece")
        both = pieces.in_pieces(a, table, by, "_at", PIECE_SECONDS).unionByName(placed).unionByName(heads)
        keys = [*by, "_piece"]
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)  # heads first: nulls
    carried = both.withColumn("_last", F.last("_value", ignorenulls=True).over(w)).where("_row is not null")
    found = carried.select("_row.*", *[F.col(f"_last.`{v}`").alias(v) for v in values])
    if piece_rows is None:
        return found
    lost = left.where(" or ".join(f"`{c}` is null" for c in [*by, left_on]))
    return found.unionByName(lost.withColumns({v: F.lit(None).cast(types[v]) for v in values}))


def band(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], hours: int) -> DataFrame:
    """Left join on ``left_on - hours < right_on <= left_on``; several matches give several rows.

    A band lies in at most two buckets of its own width, so the right side is
    entered in two buckets and the join is an equality of buckets.
    """
    width = hours * 3600
    bucket = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / width)
    keyed = right.withColumn("_first", bucket(right_on)).withColumn("_bucket", F.explode(F.array(F.col("_first"), F.col("_first") + 1))).drop("_first")
    a, b = left.withColumn("_bucket", bucket(left_on)).alias("l"), keyed.alias("r")
    inside = (F.col(f"r.{right_on}") <= F.col(f"l.{left_on}")) & (F.col(f"r.{right_on}") > F.col(f"l.{left_on}") - F.expr(f"interval {hours} hours"))
    same = F.col("l._bucket") == F.col("r._bucket")
    for c in by:
        same &= F.col(f"l.{c}") == F.col(f"r.{c}")
    extra = [F.col(f"r.{c}").alias(c) for c in right.columns if c not in by]
    return a.join(b, same & inside, "left").select(*[F.col(f"l.{c}") for c in left.columns], *extra)


def param_lookup(targets: DataFrame, studies: DataFrame, defaults: dict) -> DataFrame:
    """Parameters of the latest study strictly before each target period; defaults (numbers, or columns of the target) without one."""
    values = list(defaults)
    found = asof_backward(targets, studies.withColumn("source", F.col("period")), "period", "period", ["symbol"], [*values, "source"], strict=True)
    filled = {v: F.coalesce(F.col(v), d if isinstance(d, Column) else F.lit(d)) for v, d in defaults.items()}
    return found.withColumns(filled | {"source": F.coalesce("source", F.lit("default"))})
