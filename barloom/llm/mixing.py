"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key.  Keys are uniform, so fixed ranges of
the key split any source evenly, a hot one too: a source is sorted range by
range, the ranges' sums are scanned to give each range its offset, and a
running sum inside the range completes a distributed prefix sum.  A source is
cut at its exact budget: each whole multiple of its size is an epoch of all its
documents, and the remainder is taken in key order, the last document in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._spark import SPACE_CLASS, cut

#: Ranges a source is sorted in: 16 ** RANGE_DIGITS.
RANGE_DIGITS = 3
#: Source tables up to this many rows are broadcast; longer ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def count_words(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")).cast("long")


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources by code point, null last, weigh as the cycle says and share the
    sum of all sizes.  A target stops at ``max_epochs`` times its source's
    size; resharing the excess by weight until none is above ends where the
    sources with the least size for their weight stop, and the rest share
    what is left.  One row per source: the table is small beside the documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in cycle])
    weighed = sizes.withColumn("weight", F.element_at(weights, ((F.row_number().over(order) - 1) % len(cycle) + 1).cast("int")))
    weighed = weighed.withColumn("stop", F.lit(max_epochs) * F.col("source_size"))
    everything = Window.partitionBy()
    # Compare stop / weight exactly, as integers.
    common = 1
    for w in cycle:
        common *= w
    by_room = Window.orderBy((F.col("stop") * F.expr(f"{common} div weight")).asc(), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stopped = weighed.withColumn("stopped", F.col("stop") * weight_left <= left * F.col("weight"))
    free_size = F.sum("source_size").over(everything) - F.sum(F.when(F.col("stopped"), F.col("stop")).otherwise(0)).over(everything)
    free_weight = F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).over(everything)
    share = free_size.cast("double") * F.col("weight") / F.when(free_weight == 0, None).otherwise(free_weight)
    target = F.when(F.col("stopped"), F.col("stop").cast("double")).otherwise(share)
    return stopped.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cycle: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 1,
) -> DataFrame:
    """Every input row as ``row`` (a struct of all its columns) with ``size, source_size, target, taken``.

    ``taken`` counts the words the mix takes of the row, repeats included: at
    most ``max_epochs`` times its size; over a source they add up to the
    target rounded to whole words.  Null and empty texts have size 0 and take
    0.  A null source is one source, ordered last.  The key depends on seed and
    id (a null one: on the text) alone, so reruns agree; rows that share an id are ordered by source,
    size and text hash, and equal rows are interchangeable.  An empty table gives none.
    """
    sized = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        count_words(F.col(text_col).cast("string")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))))).alias("key"),
        F.xxhash64(F.col(text_col).cast("string")).alias("tie"),
    ).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    # Sums per source and range: at most 16 ** RANGE_DIGITS rows a source.
    ranges = cut(sized.groupBy("source", "range").agg(F.sum("size").alias("range_size")))
    by_source = cut(targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), cycle, max_epochs))
    small = by_source.count() <= BROADCAST_ROWS
    scan = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(scan), F.lit(0)).alias("offset"))
    offsets = offsets.alias("o").join(
        F.broadcast(by_source.alias("t")) if small else by_source.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))
    ).select("o.source", "range", "offset", "source_size", "target")
    if small and ranges.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)  # the texts are then shuffled once, for the window
    inside = Window.partitionBy("source", "range").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    summed = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.alias("d").join(
        offsets.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.range") == F.col("o.range"))
    )
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("before") - F.col("offset")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("row", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each whole or partial repeat.

    A partial repeat holds the first words of its text, up to the cut, with
    the white space around them; there is at most one in a source.
    """
    chosen = mix(docs, text_col=text_col, **options).where("taken > 0")
    copies = chosen.select("row", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(taken - 1) div size"))).alias("n"), "taken")
    words = F.least(F.col("size"), F.col("taken") - F.col("n") * F.col("size"))
    text = F.col(f"row.`{text_col}`")
    # Pieces keep the white space after them; one of white space alone may lead.
    pieces = F.split(text, rf"(?<={SPACE_CLASS})(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(f"^{SPACE_CLASS}"), F.lit(1)).otherwise(F.lit(0))
    first = F.array_join(F.slice(pieces, F.lit(1), (words + lead).cast("int")), "")
    part = F.when(words == F.col("size"), text).otherwise(first)
    return copies.select(*[part.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
