"""Quality rules: base measures of a text, and cross-document line frequency.

Lines are normalised (lower case, digits to 0, white space collapsed) and
hashed.  A line is *common* on a host when it stands in more than
``max(min_docs, max_share * documents of the host)`` distinct documents there;
exact copies of one text are one document, so copies alone condemn no line.
Common lines are removed, and a document is rejected when it fails the base
rules or when too little of it remains.

Everything is keyed by content (host and a 128-bit hash of the text), so that
repeated rows and null ids need no row numbers, and hot hosts, lines and
groups of copies are reduced by partial aggregation before any shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._arrow import numbers
from barloom.llm._spark import SPACE_CLASS, bound_batches

SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\f"
WINDOW = 8

_BASE_DDL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight that stand at least twice in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=n).astype(np.uint64)
    starts = n - WINDOW + 1
    key = np.zeros(starts, dtype=np.uint64)
    for i in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + starts]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(starts, dtype=bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    spots = np.flatnonzero(maybe).tolist()  # equal hashes; now the words themselves
    seen = Counter(tuple(words[i : i + WINDOW]) for i in spots)
    marks = np.zeros(n + 1, dtype=np.int64)
    for i in spots:
        if seen[tuple(words[i : i + WINDOW])] > 1:
            marks[i] += 1
            marks[i + WINDOW] -= 1
    return int((np.cumsum(marks[:-1]) > 0).sum())


def base_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    if not text:
        return (0, 0, 0, 0, 0)
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - len(raw.translate(None, _SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACES)]
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), _repeated_words(words)


def measures(text: Column) -> Column:
    """The base measures as one struct column; other columns stay on the JVM side."""

    @F.arrow_udf(f"struct<{_BASE_DDL.replace(' long', ':long')}>")
    def measured(texts: pa.Array) -> pa.Array:
        rows = [base_measures(t) for t in texts.to_pylist()]
        names = [c.split()[0] for c in _BASE_DDL.split(", ")]
        return pa.StructArray.from_arrays([numbers([r[i] for r in rows]) for i in range(5)], names=names)

    return measured(text)


def normalised_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"[0-9]", "0"), SPACE_CLASS + "+", " "))


def _line_hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def _content(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(host_col).cast("string").alias("host"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit("second"), text).alias("k2"),
        text.alias("text"),
    )


def common_lines(docs: DataFrame, text_col: str, host_col: str, min_docs: int, max_share: float) -> DataFrame:
    """``(host, line)`` hashes above the limit of their host, with ``n_docs``."""
    content = _content(docs, text_col, host_col)
    lines = content.select("host", "k1", "k2", F.explode(F.split("text", "\n")).alias("raw"))
    lines = lines.where(F.col("raw").rlike(r"[^\x20\x09-\x0D]")).select("host", "k1", "k2", _line_hash(F.col("raw")).alias("line"))
    spread = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n_docs"))
    frequent = spread.where(F.col("n_docs") > min_docs)
    hosts = content.groupBy("host", "k1", "k2").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("host_docs"))
    joined = frequent.alias("f").join(hosts.alias("h"), F.col("f.host").eqNullSafe(F.col("h.host")))
    return joined.where(F.col("n_docs") > max_share * F.col("host_docs")).select("f.host", "line", "n_docs")


def apply_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 20,
    max_repeat_pct: int = 30,
    min_docs: int = 50,
    max_share: float = 0.02,
    min_kept_pct: int = 50,
) -> DataFrame:
    """One row per input row: ``id``, ``text``, the base measures, ``n_removed_words``, ``clean_text``, ``base_failed``, ``kept``, ``row`` (a struct of the input's columns).

    ``clean_text`` lacks the common lines (null texts stay null).  ``kept`` is
    false when the base rules fail, or when fewer than ``min_kept_pct`` percent
    of the words or fewer than ``min_words`` words remain.  Null and empty
    texts have no words and fail the base rules; a null host is a host of its
    own; repeated rows get the same verdict each; an empty table gives none.
    """
    bound_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    own = {c: f"__column_{i}" for i, c in enumerate(docs.columns)}
    measured = docs.select(
        *[docs[f"`{c}`"].alias(x) for c, x in own.items()],
        F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"),
        F.xxhash64(F.lit("second"), F.coalesce(text, F.lit(""))).alias("k2"),
        measures(text).alias("base"),
    ).select(*own.values(), "id", "host", "k1", "k2", "base.*")

    common = common_lines(docs, text_col, host_col, min_docs, max_share).withColumnRenamed("host", "common_host")
    source = _content(docs, text_col, host_col)
    lines = source.select("host", "k1", "k2", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = lines.select(
        "host", "k1", "k2", _line_hash(F.col("raw")).alias("line"),
        F.size(F.filter(F.split("raw", SPACE_CLASS + "+"), lambda w: w != "")).alias("words"), "pos",
    ).where("words > 0")
    # Copies are counted once: every copy of a text has the same lines at the same places.
    struck = (
        lines.join(common, F.col("host").eqNullSafe(F.col("common_host")) & (lines.line == common.line))
        .select("host", "k1", "k2", lines.line, "pos", "words").distinct()
        .groupBy("host", "k1", "k2")
        .agg(F.sum("words").alias("removed"), F.collect_set("line").alias("struck"))
    )
    joined = measured.alias("m").join(
        struck.alias("s"),
        F.col("m.host").eqNullSafe(F.col("s.host")) & (F.col("m.k1") == F.col("s.k1")) & (F.col("m.k2") == F.col("s.k2")),
        "left",
    )
    removed = F.coalesce("removed", F.lit(0)).cast("long")
    left = F.col("n_words") - removed
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = (100 * left < min_kept_pct * F.col("n_words")) | (left < min_words)
    original = F.col(own[text_col]).cast("string")  # the row's own column: the text is shuffled once
    clean = F.when(F.col("struck").isNull(), original).otherwise(
        F.array_join(F.filter(F.split(original, "\n"), lambda x: ~F.array_contains(F.col("struck"), _line_hash(x))), "\n")
    )
    return joined.select(
        "id", original.alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        removed.alias("n_removed_words"), clean.alias("clean_text"), base_failed.alias("base_failed"),
        (~base_failed & ~depleted).alias("kept"), F.struct(*[F.col(x).alias(c) for c, x in own.items()]).alias("row"),
    )
