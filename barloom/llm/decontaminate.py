"""Benchmark decontamination by winnowing, with DataFrame functions only.

Of the k-gram hashes inside a window of ``window`` words the smallest is the
window's fingerprint.  Consecutive windows with one fingerprint are a run, and
a text keeps one row ``(fp, first, end)`` a run: equal windows have equal
fingerprints, so every shared span of ``window`` words or more shares one.
Fingerprint rows of documents are joined with those of the benchmark; only the
runs that hit are extended, window by window, and compared on their words.
Windows merge into spans.  Items shorter than a window are one window of their
own length, whose only gram is the whole item; they go through the same pass.

Documents are cut into overlapping chunks of words, so that arrays do not grow
with a text.  Results depend on the text alone and are keyed by a 128-bit hash
of it; texts with very many copies are joined apart, so no task gets them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import cut, lower_ascii

#: Neither letters of either case, nor digits, nor beyond ASCII.
_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
CHUNK_WORDS = 2048
#: Benchmark fingerprints and windows (of some hundred bytes each) up to this number are broadcast.
BROADCAST_WINDOWS = 200_000
#: Spans and items of contaminated texts up to this number are broadcast.
BROADCAST_HITS = 500_000
#: So many of the texts that have over HOT_COPIES copies meet their rows by broadcast.
HOT_TEXTS, HOT_COPIES = 10_000, 1000


def words_of(text: Column) -> Column:
    """Runs of letters, digits and non-ASCII characters, in the text's own case; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATOR + "+"), "")


def _chunks(rows: DataFrame, keys: list[str], window: int) -> DataFrame:
    """``rows`` has ``all_words``; returns ``keys, chunk, words``: every window starts in one chunk's first CHUNK_WORDS words."""
    starts = F.when(F.size("all_words") > 0, F.sequence(F.lit(0), F.size("all_words") - 1, F.lit(CHUNK_WORDS)))
    # No filter on the words: it would be pushed below and split the text again.
    placed = rows.select(*keys, "all_words", F.explode(starts).alias("chunk"))
    return placed.select(*keys, "chunk", F.slice("all_words", F.col("chunk") + 1, CHUNK_WORDS + window - 1).alias("words"))


def _fingerprint_runs(chunks: DataFrame, window: int, k: int, shorter: list[int]) -> DataFrame:
    """``chunks`` with a row for each run: ``len, fp`` and the first and end (exclusive) of its windows' places.

    Each step is a column of its own, because the next one reads it many times.
    """
    n = F.size("words")

    def grams(size: int) -> Column:
        places = F.when(n >= size, F.sequence(F.lit(0), n - size))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(F.col("_hash"), i + j) for j in range(size)]))

    def least(i: Column) -> Column:
        inside = [F.get(F.col("_gram"), i + j) for j in range(window - k + 1)]
        return F.least(*inside) if len(inside) > 1 else inside[0]

    def fresh(i: Column) -> Column:
        return (i == 0) | (F.get(F.col("_least"), i) != F.get(F.col("_least"), i - 1))

    def run(i: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(F.col("_start"), nth + 1), F.size("_least"))
        return F.struct(F.lit(window).alias("len"), F.get(F.col("_least"), i).alias("fp"), i.alias("first"), end.alias("end"))

    def alone(size: int) -> Column:
        return F.transform(grams(size), lambda g, i: F.struct(F.lit(size).alias("len"), g.alias("fp"), i.alias("first"), (i + 1).alias("end")))

    out = chunks.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("_hash"))
    out = out.select("*", grams(k).alias("_gram"))
    out = out.select("*", F.transform(F.when(n >= window, F.sequence(F.lit(0), n - window)), least).alias("_least"))
    out = out.select("*", F.filter(F.when(n >= window, F.sequence(F.lit(0), F.size("_least") - 1)), fresh).alias("_start"))
    none = F.array().cast("array<struct<len:int,fp:bigint,first:int,end:int>>")
    parts = [F.coalesce(F.transform("_start", run), none), *[F.coalesce(alone(size), none) for size in shorter]]
    out = out.select(*chunks.columns, F.explode(F.concat(*parts) if shorter else parts[0]).alias("_run"))
    return out.select(*chunks.columns, "_run.*")


def _windows(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, pos, len, fp, win`` for every window of the runs, ``win`` its words joined by a space."""
    placed = runs.select("*", F.explode(F.sequence("first", F.col("end") - 1)).alias("_at")).where(F.col("_at") < CHUNK_WORDS)
    text = F.array_join(F.slice("words", F.col("_at") + 1, F.col("len")), " ")
    return placed.select(*keys, (F.col("chunk") + F.col("_at")).alias("pos"), "len", "fp", text.alias("win"))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, k: int) -> DataFrame:
    """``(item, len, fp, win)``: every window of every item."""
    folded = lower_ascii(F.col(text_col).cast("string"))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words_of(folded).alias("all_words"))
    items = cut(items.select("*", F.size("all_words").alias("_n")))
    sizes = items.where(F.col("_n").between(1, window - 1)).select("_n").distinct().collect()  # fewer than ``window`` rows
    out = _fingerprint_runs(_chunks(items.where(F.col("_n") >= window), ["item"], window), window, k, [])
    for r in sizes:
        out = out.unionByName(_fingerprint_runs(_chunks(items.where(F.col("_n") == r._n), ["item"], window), window, k, [r._n]))
    return _windows(out, ["item"]).select("item", "len", "fp", "win").distinct()


def _checked(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def _hits(chunks: DataFrame, known: DataFrame, window: int, k: int) -> DataFrame:
    """``(k1, k2, pos, len, win, copies)``: the documents' windows that stand in the benchmark."""
    prints = known.select("len", "fp").distinct()
    shapes = [r.len for r in prints.select("len").distinct().collect()]  # at most ``window`` rows
    runs = _fingerprint_runs(chunks, window, k, [n for n in shapes if n < window])
    if prints.count() <= BROADCAST_WINDOWS:
        found = runs.join(F.broadcast(prints), ["len", "fp"], "left_semi")
    else:  # rows of seven numbers are shuffled; words are fetched for the chunks that hit
        spots = runs.select("k1", "k2", "chunk", "len", "fp", "first", "end").join(prints, ["len", "fp"], "left_semi")
        spots = cut(spots.groupBy("k1", "k2", "chunk").agg(F.collect_set(F.struct("len", "fp", "first", "end")).alias("runs")))
        found = chunks.join(_checked(spots, BROADCAST_WINDOWS), ["k1", "k2", "chunk"])
        found = found.select("k1", "k2", "chunk", "words", F.explode("runs").alias("_run")).select("k1", "k2", "chunk", "words", "_run.*")
    windows = known.select("win").distinct()
    # A text's copies all hit at the same places: their number comes with the hits.
    return cut(
        _windows(found, ["k1", "k2"]).join(_checked(windows, BROADCAST_WINDOWS), "win")
        .groupBy("k1", "k2", "pos", "len", "win").agg(F.count("*").alias("copies"))
    )


def _spans(places: Column) -> Column:
    """Distinct ascending word places as ``(first, end)`` runs; ``places`` is a column of its own."""
    starts = F.filter(places, lambda x, i: (i == 0) | (F.get(places, i - 1) != x - 1))
    ends = F.filter(places, lambda x, i: (i == F.size(places) - 1) | (F.get(places, i + 1) != x + 1))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("end")))


def _per_text(hits: DataFrame, known: DataFrame) -> DataFrame:
    """``(k1, k2, spans, items, copies)`` of every contaminated text."""
    covered = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("pos", F.col("pos") + F.col("len") - 1)))))
    spans = hits.groupBy("k1", "k2").agg(covered.alias("places"), F.max("copies").alias("copies"))
    spans = spans.select("k1", "k2", "copies", _spans(F.col("places")).alias("spans"))
    named = hits.select("k1", "k2", "win").distinct().join(_checked(known.select("item", "win"), BROADCAST_WINDOWS), "win")
    items = named.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return cut(spans.join(items, ["k1", "k2"]))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
) -> DataFrame:
    """One row per input row: ``id``, ``row`` (a struct of all its columns), ``n_words``, ``n_hit``, ``items`` (sorted strings), ``spans``.

    ``spans`` are ``(first, end)`` word positions, merged and in order.  Null
    and empty texts have no words.  A null item id counts as the item "";
    items that share an id are one item.  Repeated rows get equal results.
    An empty table on either side gives no hits (or no rows).
    """
    known = cut(benchmark_windows(benchmark, item_col, item_text_col, window, k))
    text = F.col(text_col).cast("string")
    keys = [F.xxhash64(F.coalesce(text, F.lit(""))).alias("k1"), F.xxhash64(F.lit("second"), F.coalesce(text, F.lit(""))).alias("k2")]
    chunks = _chunks(docs.select(*keys, words_of(lower_ascii(text)).alias("all_words")), ["k1", "k2"], window)
    per_text = _per_text(_hits(chunks, known, window, k), known)

    own = {c: f"__column_{i}" for i, c in enumerate(docs.columns)}  # flat, so that unused ones are pruned
    rows = docs.select(*[docs[f"`{c}`"].alias(x) for c, x in own.items()], *keys, F.size(words_of(text)).cast("long").alias("n_words"))
    found = ["spans", "items"]
    size = per_text.agg(F.sum(F.size("spans") + F.size("items"))).first()[0] or 0
    if size <= BROADCAST_HITS:
        joined = rows.join(F.broadcast(per_text.select("k1", "k2", *found)), ["k1", "k2"], "left")
    else:
        joined = _joined_by_shuffle(rows, per_text, own[id_col], found)
    empty = F.array().cast("array<struct<first:int,end:int>>")
    n_hit = F.aggregate(F.coalesce("spans", empty), F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["first"])
    return joined.select(
        F.col(own[id_col]).alias("id"), F.struct(*[F.col(x).alias(c) for c, x in own.items()]).alias("row"), "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", empty).alias("spans"),
    )


def _joined_by_shuffle(rows: DataFrame, per_text: DataFrame, id_col: str, found: list[str]) -> DataFrame:
    """``rows`` with ``found`` of their text: the texts with most copies by broadcast, so that no task gets all copies of one.

    Any text outside the HOT_TEXTS most copied has fewer copies than each of those, so at most one row in HOT_TEXTS.
    """
    hot = cut(per_text.where(F.col("copies") > HOT_COPIES).orderBy(F.desc("copies"), "k1", "k2").limit(HOT_TEXTS))
    hot = hot.select("k1", "k2", F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in found])
    rest = per_text.join(F.broadcast(hot.select("k1", "k2")), ["k1", "k2"], "left_anti").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), *found)
    both = rows.join(F.broadcast(hot), ["k1", "k2"], "left")
    # Rows that have their answer go anywhere; the key they get has no second half to match.
    k1 = F.when(F.col("_hot"), F.xxhash64(id_col)).otherwise(F.col("k1"))
    k2 = F.when(F.col("_hot").isNull(), F.col("k2"))
    both = both.withColumns({"_j1": k1, "_j2": F.coalesce(k2, F.lit(0))}).join(rest, (F.col("_j1") == F.col("_k1")) & (F.col("_j2") == F.col("_k2")) & F.col("_hot").isNull(), "left")
    picked = [F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in found]
    return both.select(*rows.columns, *picked)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans`` (as ``contamination`` counts them).

    Pieces are a word with the separators after it; separators that lead the
    text are a piece of their own, and stay.  The pieces between spans are
    joined slice by slice, in one pass over the text.
    """
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    split = F.split(text, rf"(?<={_SEPARATOR})(?={word})")
    lead = F.when(text.rlike(f"^{_SEPARATOR}"), F.lit(1)).otherwise(F.lit(0))

    def kept(x: Column) -> Column:  # x: the pieces and their offset, worked out once
        def gap(i: Column) -> Column:
            first = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"] + x["lead"])
            end = F.when(i == F.size(spans), F.size(x["pieces"])).otherwise(F.get(spans, i)["first"] + x["lead"])
            return F.array_join(F.slice(x["pieces"], first + 1, F.greatest(end - first, F.lit(0))), "")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), gap), "")

    return F.transform(F.array(F.struct(split.alias("pieces"), lead.alias("lead"))), kept)[0]
