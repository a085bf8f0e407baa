"""Substring deduplication with suffix automata of reference shards.

A window is ``window`` consecutive words of one document; a word goes when a
window over it also starts in a document with a smaller id.

1. Each window has an *anchor*: the smallest hash of the k-grams inside it.
   Equal windows have equal anchors, so only windows whose anchor stands in
   two documents can repeat.  Anchors are counted per batch before they are
   shuffled: a passage that a third of all documents share costs a row a batch.
2. The windows of one anchor occurrence form a *unit*, the text from the first
   window to the end of the last.  Distinct units of one anchor with their
   smallest id are a reference shard.
3. A shard's suffix automaton is shipped to the task that streams the shard's
   units: matching statistics tell for every window whether, and in which
   document first, the words already stood.  Units that bring new windows are
   added; ids ascend, so a state's first document is its smallest.
   Anchors beyond ``MAX_UNITS`` distinct units are split by a hash of the whole
   window, so no shard outgrows a task; every window is decided by an automaton.
4. Every distinct window then has one owner, the smallest id that holds it.
   Documents learn the windows they own and drop the words of all others
   that are shared; maximal spans are the unions of such windows.

Hashes only select and route; whether words are equal is decided on the words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import bound_batches, discard, stored

#: Words of a k-gram; a window of 13 words holds nine of them.
GRAM = 5
MAX_UNITS = 2000
_LAST_ID = (1 << 63) - 1

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
#: Longer texts are hashed in pieces; words of over half a piece by another hash, in any text.
_PIECE = 1 << 17


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_BASE, _PIECE + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _PIECE + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of every white-space-separated word, without a loop over words."""
    if len(raw) > _PIECE:  # long texts in pieces that end at white space
        words, out, held, size = raw.split(), [], [], 0
        for word in words:
            if size + len(word) > _PIECE // 2 and held:
                out.append(word_hashes(b" ".join(held)))
                held, size = [], 0
            if len(word) > _PIECE // 2:
                out.append(np.array([xxhash.xxh64_intdigest(word)], dtype=np.uint64))
                continue
            held.append(word)
            size += len(word) + 1
        return np.concatenate([*out, word_hashes(b" ".join(held))])
    data = np.frombuffer(raw, dtype=np.uint8)
    space = np.concatenate([[True], _IS_SPACE[data], [True]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(data)], out=sums[1:])
    out = _mix((sums[ends] - sums[starts]) * _INVERSE[starts])
    for i in np.flatnonzero(ends - starts > _PIECE // 2).tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]])
    return out


def anchors(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window its anchor's hash (int64) and the anchor's word position."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    k = min(GRAM, window)
    grams = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for i in range(k):
        grams = grams * np.uint64(_STEP) + hashes[i : i + len(grams)]
    grams = _mix(grams)
    inside = window - k + 1
    least = grams[:n].copy()
    for j in range(1, inside):
        np.minimum(least, grams[j : j + n], out=least)
    place = np.empty(n, dtype=np.int64)
    for j in range(inside - 1, -1, -1):  # the leftmost of equals
        place[grams[j : j + n] == least] = j
    return least.view(np.int64), place + np.arange(n)


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _count_anchors(batches, window: int):
    """Rows ``(h, lo, hi)`` per batch and anchor, and ``(h, id, null)`` where the batch alone shows the repeat."""
    for batch in batches:
        hashes, owners = [], []
        for doc, raw in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
            own = np.unique(anchors(word_hashes(raw), window)[0])
            hashes.append(own)
            owners.append(np.full(len(own), doc, dtype=np.int64))
        h, ids = np.concatenate(hashes), np.concatenate(owners)
        if not len(h):
            continue
        order = np.lexsort((ids, h))
        h, ids = h[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        lo, hi = ids[first], ids[np.append(first[1:], len(h)) - 1]
        shared = np.repeat(lo < hi, np.diff(np.append(first, len(h))))
        yield pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(lo), pa.array(hi)], names=["h", "lo", "hi"])
        yield pa.RecordBatch.from_arrays([pa.array(h[shared]), pa.array(ids[shared]), pa.nulls(int(shared.sum()), pa.int64())], names=["h", "lo", "hi"])


def _units(raw: bytes, marks: np.ndarray, window: int):
    """``(h, first word, words)`` of every run of windows with one marked anchor."""
    h, place = anchors(word_hashes(raw), window)
    if not len(h) or not len(marks):
        return [], None
    marked = np.isin(h, marks)
    run = np.concatenate([[True], (place[1:] != place[:-1]) | (marked[1:] != marked[:-1])])
    firsts = np.flatnonzero(run)
    lasts = np.append(firsts[1:], len(h)) - 1
    chosen = marked[firsts]
    words = raw.split()
    return [(int(h[a]), int(a), words[a : b + window]) for a, b in zip(firsts[chosen].tolist(), lasts[chosen].tolist(), strict=True)], words


def _emit_units(batches, window: int):
    for batch in batches:
        least: dict[tuple[int, bytes], int] = {}
        for doc, raw, marks in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2), strict=True):
            for h, _, words in _units(raw, np.asarray(marks.values, dtype=np.int64), window)[0]:
                key = (h, b" ".join(words))
                if doc < least.get(key, _LAST_ID + 1):
                    least[key] = doc
        keys = list(least)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([h for h, _ in keys], type=pa.int64()),
                pa.array([t for _, t in keys], type=pa.binary()).cast(pa.string()),
                pa.array(list(least.values()), type=pa.int64()),
            ],
            names=["h", "words", "id"],
        )


class SuffixAutomaton:
    """Of several sequences, each with a document id; ids must not descend."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def add(self, words: list, doc: int) -> None:
        nexts, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for c in words:
            if (q := nexts[last].get(c)) is not None:  # a known string goes on
                if length[q] == length[last] + 1:
                    last = q
                    continue
                last = self._clone(last, c, q)
                continue
            cur = len(nexts)
            nexts.append({})
            length.append(length[last] + 1)
            first.append(doc)
            link.append(0)
            p = last
            while p != -1 and c not in nexts[p]:
                nexts[p][c] = cur
                p = link[p]
            if p != -1:
                q = nexts[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = cur

    def _clone(self, p: int, c, q: int) -> int:
        nexts, link, length, first = self.next, self.link, self.length, self.first
        new = len(nexts)
        nexts.append(dict(nexts[q]))
        length.append(length[p] + 1)
        first.append(first[q])
        link.append(link[q])
        link[q] = new
        while p != -1 and nexts[p].get(c) == q:
            nexts[p][c] = new
            p = link[p]
        return new

    def matches(self, words: list, window: int) -> list[int]:
        """For each window of ``words`` the first document that holds it, or -1."""
        nexts, link, length = self.next, self.link, self.length
        out, state, size = [], 0, 0
        for i, c in enumerate(words):
            while state and c not in nexts[state]:
                state = link[state]
                size = length[state]
            if c in nexts[state]:
                state = nexts[state][c]
                size += 1
            if i >= window - 1:
                if size >= window:
                    at = state
                    while length[link[at]] >= window:
                        at = link[at]
                    out.append(self.first[at])
                else:
                    out.append(-1)
        return out


def _owned_runs(owners: list[int]) -> list[tuple[int, int, int]]:
    runs, start = [], 0
    for i in range(1, len(owners) + 1):
        if i == len(owners) or owners[i] != owners[start]:
            runs.append((owners[start], start, i))
            start = i
    return runs


def _unit_key(words: bytes) -> int:
    """What ``xxhash64`` gives; it only tells the units of one document apart."""
    key = xxhash.xxh64_intdigest(words, 42)
    return key - (1 << 64) if key >> 63 else key


def _stream_shards(batches, window: int):
    """Rows come by anchor and ascending id; one automaton lives at a time."""
    shard, automaton = None, SuffixAutomaton()
    for batch in batches:
        rows = []
        for h, unit, text, doc, at in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if h != shard:
                shard, automaton = h, SuffixAutomaton()
            words = text.encode().split()
            owners = automaton.matches(words, window)
            if -1 in owners:  # new material joins the reference
                automaton.add(words, doc)
                owners = [doc if x == -1 else x for x in owners]
            rows += [(owner, unit, at + a, at + b) for owner, a, b in _owned_runs(owners)]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
            names=["id", "unit", "first", "last"],
        )


def _strip(batches, window: int):
    for batch in batches:
        sizes, removed, kept = [], [], []
        for raw, marks, own in zip(_texts(batch.column(1)), batch.column(2), batch.column(3).to_pylist(), strict=True):
            units, words = _units(raw, np.asarray(marks.values, dtype=np.int64), window) if marks.is_valid else ([], None)
            if words is None:
                words = raw.split()
            mine: dict[int, list] = {}
            for o in own or ():
                mine.setdefault(o["unit"], []).append((o["first"], o["last"]))
            cover = np.zeros(len(words) + 1, dtype=np.int32)
            for _, start, unit in units:
                n = len(unit) - window + 1
                shared = [True] * n
                for a, b in mine.get(_unit_key(b" ".join(unit)), ()):
                    shared[a:b] = [False] * (b - a)
                for j in range(n):
                    if shared[j]:
                        cover[start + j] += 1
                        cover[start + j + window] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            sizes.append(len(words))
            removed.append(int(gone.sum()))
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()] if gone.any() else words))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_removed, kept_text``.

    ``kept_text`` is the words left, joined by one space.  Windows are judged
    on the input.  Null texts have no words.  Rows that share an id are one
    document's: they take no words from each other; null ids come after all
    others.  Texts shorter than a window keep everything; an empty table gives
    none.  Other columns are ignored, whatever their names.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    counted = stored(rows.mapInArrow(lambda b: _count_anchors(b, window), "h long, lo long, hi long"), "anchors")
    # One exchange serves both sides; a batch sends each anchor once, so no anchor is hot here.
    by_anchor = counted.where("hi is not null").repartition("h")
    spread = by_anchor.groupBy("h").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
    # The condition needs both sides, lest it be pushed below the exchange they share.
    alone = by_anchor.join(spread, "h").where("case when least < most then lo = hi else false end").select("h", F.col("lo").alias("id"))
    shared = counted.where("hi is null").select("h", F.col("lo").alias("id"))
    marks = stored(alone.unionByName(shared).groupBy("id").agg(F.collect_set("h").alias("marks")), "marks")
    discard(counted)

    units = rows.join(marks, "id").select("id", "text", "marks").mapInArrow(lambda b: _emit_units(b, window), "h long, words string, id long")
    units = stored(units.groupBy("h", "words").agg(F.min("id").alias("id")), "units")
    sizes = units.groupBy("h").agg(F.count("*").alias("n"))
    sized = units.join(sizes, "h").withColumn("unit", F.xxhash64("words"))
    whole = sized.where(F.col("n") <= MAX_UNITS).select("h", "unit", "words", "id", F.lit(0).alias("at"))
    # An anchor with very many units: every window is dealt by a hash of itself, and streamed like a unit.
    apart = sized.where(F.col("n") > MAX_UNITS).select("unit", "id", F.split("words", " ").alias("w"))
    apart = apart.select("unit", "id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - window)).alias("at"))
    apart = apart.select("unit", "id", "at", F.array_join(F.slice("w", F.col("at") + 1, window), " ").alias("words")).withColumn("h", F.xxhash64("words"))
    shards = whole.unionByName(apart).repartition("h").sortWithinPartitions("h", "id")
    streamed = shards.mapInArrow(lambda b: _stream_shards(b, window), "id long, unit long, first int, last int")
    owned = streamed.groupBy("id").agg(F.collect_set(F.struct("unit", "first", "last")).alias("owned"))
    known = stored(marks.join(owned, "id", "left"), "owned")
    discard(marks, units)
    stripped = rows.join(known, "id", "left").select("id", "text", "marks", "owned").mapInArrow(
        lambda b: _strip(b, window), "id long, n_words long, n_removed long, kept_text string"
    )
    return stripped.select(F.when(F.col("id") != _LAST_ID, F.col("id")).alias(id_col), "n_words", "n_removed", "kept_text")
