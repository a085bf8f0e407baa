"""Filter interaction audit: what each filter of a chain removes, in every order.

One pass gives every document the mask of the filters that it fails.  All
questions about orders depend only on how many documents of a part have each
mask.  With ``x_i`` the degree to which filter i is on, a part's removals are
the polynomial

    f(x) = sum over masks M of n(M) * (1 - product over i in M of (1 - x_i)),

the multilinear extension of "documents removed by a set of filters".  Its
value at a 0/1 corner is what that set removes, so survivors of every prefix of
every order are corner evaluations; the Shapley value of a filter is the
integral of its partial derivative along the diagonal, taken over exact
rationals.  Documents are never sorted into orders: the work after the one
aggregation is a row a part.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._arrow import numbers
from barloom.llm._spark import SPACE_CLASS

#: Orders grow as a factorial.
MOST_FILTERS = 6
#: Documents counted for each mask; ``n`` is all of them.
MEASURES = ("n", "good", "toxic")


class Removals:
    """The multilinear extension of a part's removals: a coefficient for every set (bit mask) of filters."""

    def __init__(self, counts: list[int]):
        """``counts``: documents by the mask of filters they fail."""
        self.filters = len(counts).bit_length() - 1
        above = list(counts)  # documents that fail at least the filters of a set
        for i in range(self.filters):
            for s in range(len(above)):
                if not s >> i & 1:
                    above[s] += above[s | 1 << i]
        # 1 - (1-a)(1-b)... = the sum over non-empty sets of their product, signs alternating by size.
        self.coefficients = [0 if s == 0 else above[s] * (-1) ** (s.bit_count() + 1) for s in range(len(above))]

    def corners(self) -> list[int]:
        """Its value with exactly the filters of each set on: the documents that the set removes."""
        values = list(self.coefficients)
        for i in range(self.filters):
            for s in range(len(values)):
                if s >> i & 1:
                    values[s] += values[s ^ 1 << i]
        return values

    def shapley(self, i: int) -> Fraction:
        """The integral over t from 0 to 1 of the partial derivative by ``x_i`` at ``(t, ..., t)``."""
        derivative = [0] * self.filters  # by the power of t
        for s, c in enumerate(self.coefficients):
            if s >> i & 1:
                derivative[s.bit_count() - 1] += c
        return sum((Fraction(c, power + 1) for power, c in enumerate(derivative)), Fraction(0))


def audited(counts: dict[str, list[int]], letters: str) -> list[tuple]:
    """A part's rows ``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``."""
    polynomials = {m: Removals(counts[m]) for m in MEASURES}
    total, full = sum(counts["n"]), len(counts["n"]) - 1
    gone = {m: p.corners() for m, p in polynomials.items()}
    value = [polynomials["n"].shapley(i) * factorial(len(letters)) for i in range(len(letters))]
    assert all(v.denominator == 1 for v in value)
    rows = []
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            lost = {m: gone[m][after] - gone[m][before] for m in MEASURES}
            alone = gone["n"][full] - gone["n"][full ^ 1 << i]
            rows.append((name, step, total - gone["n"][after], lost["n"], gone["n"][1 << i] - lost["n"], alone, lost["good"], lost["toxic"], int(value[i])))
            before = after
    return rows


def interactions(masks: DataFrame, letters: str) -> DataFrame:
    """Rows of ``audited`` with their ``part``, from ``(part, mask, n, good, toxic)`` with one row a part and mask."""
    if len(letters) > MOST_FILTERS:
        raise ValueError(f"{len(letters)} filters have {factorial(len(letters))} orders; at most {MOST_FILTERS} are audited")
    names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = {m: [0] * (1 << len(letters)) for m in MEASURES}
                for entry in row["masks"]:
                    for m in MEASURES:
                        counts[m][entry["mask"]] += entry[m]
                columns = list(zip(*audited(counts, letters), strict=True))
                arrays = [pa.array([row["part"]] * len(columns[0]), pa.string()), pa.array(columns[0], pa.string())]
                yield pa.RecordBatch.from_arrays([*arrays, *[numbers(c) for c in columns[1:]]], names=["part", *names])

    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", *MEASURES)).alias("masks"))  # at most a row a mask
    longs = ", ".join(f"{n} long" for n in names[1:])
    return parts.mapInArrow(run, f"part string, filter_order string, {longs}").withColumn("step", F.col("step").cast("int"))


def text_conditions(text: Column) -> dict[str, Column]:
    """Fixed values of the audit: when a text fails each filter that looks at the text alone."""
    words = F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str, conditions: dict[str, Column]) -> DataFrame:
    """``(part, mask, n, good, toxic)``: bit i of a mask is the i-th condition, the bit after the last one "copy of an earlier text".

    Copies meet by two 64-bit hashes of the text.  What a group of copies
    sends is a row for each id and task, then a row for each part and label,
    so the largest group is never in one task.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    mask = F.lit(0)
    for i, failed in enumerate(conditions.values()):
        mask = mask + F.when(failed, 1 << i).otherwise(0)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"), mask.alias("mask"),
    )
    judged = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    known = rows.where("id IS NOT NULL").join(judged.where("id IS NOT NULL"), "id", "left").fillna(0, ["good", "toxic"])
    nameless = rows.where("id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})  # they have no label, and would be one hot key
    group = ["k1", "k2", "part", "mask", "good", "toxic"]
    per_id = known.select("id", *group).unionByName(nameless.select("id", *group)).groupBy("id", *group).agg(F.count("*").alias("c"))
    per_text = per_id.groupBy(*group).agg(F.sum("c").alias("n"), F.min("id").alias("first"), F.min_by("c", "id").alias("n_first"))
    least = F.expr("min(first) OVER (PARTITION BY k1, k2)")  # a row for each part and label of a text
    marked = per_text.withColumn("least", least)
    firsts = F.when(F.col("least").isNull(), F.col("n")).when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    copy = 1 << len(conditions)
    split = marked.select(
        "part", "good", "toxic",
        F.explode(F.array(F.struct(F.col("mask"), firsts.alias("c")), F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - firsts).alias("c")))).alias("e"),
    ).select("part", "good", "toxic", "e.mask", "e.c").where("c > 0")
    return split.groupBy("part", "mask").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("good")).alias("good"), F.sum(F.col("c") * F.col("toxic")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters A to E and step, zeros included (``shapley``: times the number of orders).

    Filters A to D judge the text, E fails for the copy of a text that an
    earlier id has, in any part.  A null text is empty; a null part is the
    empty string's; a null id is later than all others and no copy of another
    null id; rows repeated with the same id are not copies of each other.  A
    document is good or toxic if any label of its id says so; labels with null
    ids or values say nothing.  Parts without documents, and an empty table,
    give no rows; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    conditions = text_conditions(text)
    return interactions(failure_masks(docs, labels, id_col, text_col, part_col, conditions), "".join(conditions) + "E")
