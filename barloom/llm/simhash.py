"""SimHash near-duplicate detection over a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints that differ
in ``d`` bits differ in at most ``d`` bytes, so they share at least ``8 - d``
positional bytes: the guaranteed minimum that count filtering asks for.

Posting lists of one positional byte would hold 1/256 of all fingerprints and
make the pairs quadratic, so postings are keyed by *groups* of positions,
chosen so that any pair with the guaranteed matches shares at least one whole
group: eight groups of three bytes for up to three differing bits.  In a
posting list the shared positional bytes of each pair are tallied; pairs that
reach the minimum are verified by their Hamming distance.  Lists beyond
``max_postings`` are refined (two more matching positions must join the key)
and lists that stay long are linked exactly, without any pairs, through the
points between fingerprints (``_dense_links``).  Nothing is capped or dropped.

Components come from randomised contraction: every node joins the smallest
hash among its neighbours and itself, the graph shrinks by a constant factor a
round, and neither links nor components ever reach the driver.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm._arrow import binaries, flags, lists, numbers
from barloom.llm._spark import bound_batches, cut, discard, stored
from barloom.llm.substrings import word_hashes

SEED = 42
#: Shingle hashes held at once by one Python worker (64 bytes each as lanes).
CHUNK = 1 << 17

#: byte -> eight one-byte lanes holding its bits, most significant first.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view("<u8").ravel()


class _BitCounts:
    """Per-document counts of set bits, fed a bounded number of hashes at a time."""

    def __init__(self, docs: int):
        self.totals = np.zeros((docs, 64), dtype=np.int64)
        self.shingles = np.zeros(docs, dtype=np.int64)
        self._hashes: list[int] = []
        self._runs: list[tuple[int, int]] = []

    def add(self, doc: int, hashes: list[int]) -> None:
        self._hashes += hashes
        self._runs.append((doc, len(hashes)))
        self.shingles[doc] += len(hashes)
        if len(self._hashes) >= CHUNK:
            self.flush()

    def flush(self) -> None:
        if not self._hashes:
            return
        lanes = _LANES[np.array(self._hashes, dtype=">u8").view(np.uint8)].reshape(-1, 8)
        docs, starts, at = [], [], 0
        for doc, n in self._runs:  # a lane holds sums up to 255
            steps = range(at, at + n, 255)
            starts += steps
            docs += [doc] * len(steps)
            at += n
        sums = np.add.reduceat(lanes, starts, axis=0).view(np.uint8).reshape(-1, 64)
        np.add.at(self.totals, docs, sums)
        self._hashes, self._runs = [], []

    def fingerprints(self) -> np.ndarray:
        self.flush()
        majority = self.totals * 2 > self.shingles[:, None]
        return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.int64)


def _shingle_hashes(words: list[bytes], size: int, out) -> None:
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        out([digest(b" ".join(words), SEED)])
        return
    for first in range(0, len(words) - size + 1, CHUNK):
        part = words[first : first + CHUNK + size - 1]
        joined = b" ".join(part)
        ends = list(accumulate(map(len, part), lambda a, b: a + b + 1))
        starts = [0, *[e + 1 for e in ends[: len(part) - size]]]
        out([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=True)])


def fingerprint_texts(texts: list[bytes | None], shingle_words: int) -> np.ndarray:
    """SimHash of each text as int64; texts without words (or null) get zero."""
    counts = _BitCounts(len(texts))
    for i, text in enumerate(texts):
        if text and (words := text.lower().split()):  # bytes: ASCII case and white space only
            _shingle_hashes(words, shingle_words, lambda hashes, i=i: counts.add(i, hashes))
    return counts.fingerprints()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``(id, fp)`` for every row, one pass over the text and no shuffle."""

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                fps = fingerprint_texts(part.column(1).cast(pa.binary()).to_pylist(), shingle_words)
                yield pa.RecordBatch.from_arrays([part.column(0), numbers(fps)], names=["id", "fp"])

    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes agree."""
    differing = a.bitwiseXOR(b)
    tally = F.lit(0)
    for position in range(8):
        tally = tally + F.when(_byte(differing, position) == 0, 1).otherwise(0)
    return tally


def position_groups(distance: int) -> list[tuple[int, ...]]:
    """Groups of positions of which every ``8 - distance`` positions contain one whole."""
    if distance <= 3:  # of five positions three lie in one half
        return [g for half in (range(4), range(4, 8)) for g in combinations(half, 3)]
    if distance <= 5:  # of three positions two lie in one half
        return [g for half in (range(4), range(4, 8)) for g in combinations(half, 2)]
    return [(p,) for p in range(8)]


def _masked(fp: Column, positions: tuple[int, ...]) -> Column:
    return fp.bitwiseAND(F.lit(_signed(sum(255 << (8 * p) for p in positions))).cast("long"))


def _postings(fps: DataFrame, groups: list[tuple[int, ...]]) -> DataFrame:
    entries = [F.struct(F.lit(i).alias("grp"), _masked(F.col("fp"), g).alias("bytes")) for i, g in enumerate(groups)]
    return fps.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.grp", "e.bytes")


def _pairs(postings: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links within posting lists: tally, count filter, verification."""
    left = postings.select(*keys, F.col("fp").alias("a"))
    right = postings.select(*keys, F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    found = left.join(right, keys).where(
        (a < b) & (shared_bytes(a, b) >= 8 - distance) & (F.bit_count(a.bitwiseXOR(b)) <= distance)
    )
    return found.select("a", "b")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _dense_links(dense: DataFrame, free_bits: dict[int, list[int]], distance: int) -> DataFrame:
    """Links that join the same fingerprints as all pairs of a long list would.

    Every two fingerprints within ``distance`` have a point within ``near`` of
    the one and ``distance - near`` of the other.  All fingerprints near a
    point are linked to one of them, as are those farther off; both links are
    true ones, and a list of m fingerprints makes a multiple of m rows.  The
    flips are a fixed table: at most 56 entries of a few thousand masks.
    """
    near, far = distance // 2, distance - distance // 2
    flips = [
        (code, k <= near, _signed(sum(1 << b for b in chosen)))
        for code, bits in free_bits.items()
        for k in range(far + 1)
        for chosen in combinations(bits, k)
    ]
    ball = dense.sparkSession.createDataFrame(flips, "sub int, near boolean, mask long")
    keys = ["sub", "sub_bytes", "point"]
    points = dense.join(F.broadcast(ball), "sub").select(
        "sub", "sub_bytes", "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "near"
    )
    hubs = points.where("near").groupBy(*keys).agg(F.min("fp").alias("hub"))
    linked = points.join(hubs, keys).where("fp <> hub")
    return linked.select(F.least("fp", "hub").alias("a"), F.greatest("fp", "hub").alias("b"))


def links(fps: DataFrame, distance: int = 3, max_postings: int = 512) -> DataFrame:
    """Links ``(a, b)`` that join what all pairs within ``distance`` join.

    ``fps``: distinct fingerprints ``fp``.  Lists of up to ``max_postings``
    give all their pairs; longer ones give a spanning set of true links.
    """
    groups = position_groups(distance)
    postings = _postings(fps, groups)
    sizes = postings.groupBy("grp", "bytes").agg(F.count("*").alias("n"))
    keys = ["grp", "bytes"]
    long_lists = sizes.where(F.col("n") > max_postings).select(*keys)
    listed = postings.join(sizes.where(F.col("n").between(2, max_postings)).select(*keys), keys)
    out = _pairs(listed, keys, distance)

    # Long lists: each pair shares more positions besides the group's own.
    crowded = cut(postings.join(long_lists, keys))
    if crowded.isEmpty():
        return out.distinct()
    more = 8 - distance - len(groups[0])
    entries, free_bits = [], {}
    for i, group in enumerate(groups):
        for extra in combinations([p for p in range(8) if p not in group], more):
            code = len(free_bits)
            free_bits[code] = [b for p in range(8) if p not in group and p not in extra for b in range(8 * p, 8 * p + 8)]
            entries.append((i, code, tuple(sorted(group + extra))))
    refined = F.filter(
        F.array(
            *[
                F.when(F.col("grp") == i, F.struct(F.lit(c).cast("int").alias("sub"), _masked(F.col("fp"), ps).alias("sub_bytes")))
                for i, c, ps in entries
            ]
        ),
        lambda e: e.isNotNull(),
    )
    finer = cut(crowded.select("fp", F.explode(refined).alias("e")).select("fp", "e.sub", "e.sub_bytes"))
    keys = ["sub", "sub_bytes"]
    sizes = finer.groupBy(*keys).agg(F.count("*").alias("n"))
    short = finer.join(sizes.where(F.col("n").between(2, max_postings)).select(*keys), keys)
    dense = cut(finer.join(sizes.where(F.col("n") > max_postings).select(*keys), keys))
    out = out.unionByName(_pairs(short, keys, distance))
    if not dense.isEmpty():
        out = out.unionByName(_dense_links(dense, free_bits, distance))
    return out.distinct()


#: Words of the XOR bitmap of a shingle set (512 bits).
BITMAP = 8
#: Sets of more shingles than this have a bitmap of WIDE bits too, for pairs the small one lets through.
WIDE_FROM, WIDE = 1000, 8192
#: So many of the shingles that stand in over FREQUENT_FROM prefixes come last in every set's order.
FREQUENT, FREQUENT_FROM = 100_000, 16
#: Candidates up to this number are sent to the tasks that read their texts.
BROADCAST_NODES = 1_000_000


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending; a text of fewer words is one shingle."""
    hashes = word_hashes((text or b"").lower())
    if not len(hashes):
        return hashes.astype(np.uint64)
    size = min(size, len(hashes))
    out = np.zeros(len(hashes) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(0xD1B54A32D192ED03) + hashes[i : i + len(out)]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return np.unique(out ^ (out >> np.uint64(29)))


def _set_key(shingles: np.ndarray) -> int:
    key = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return key - (1 << 64) if key >> 63 else key


def _set_fingerprint(shingles: np.ndarray) -> int:
    """SimHash of a shingle set as int64: bits set in over half of the hashes; zero for none."""
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(shingles), CHUNK):
        counts += np.unpackbits(shingles[lo : lo + CHUNK].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles)).view(np.int64)[0])


def prefix_length(n: int, similarity: float) -> int:
    """Two sets that reach ``similarity`` share one of so many first elements of each, in any common order."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def _prefix(shingles: np.ndarray, similarity: float, frequent: np.ndarray) -> np.ndarray:
    """The first shingles of a set in an order common to all sets: frequent ones last, then by hash."""
    length = prefix_length(len(shingles), similarity)
    if not len(frequent) or not length:
        return shingles[:length]
    often = frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles
    return np.concatenate([shingles[~often], shingles[often]])[:length]


def _texts(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def frequent_shingles(keyed: DataFrame, size: int, similarity: float) -> np.ndarray:
    """The shingles in most prefixes by hash alone, ascending: a fixed number, whatever the corpus.

    Any order of shingles finds all pairs; this one keeps passages that many
    texts share out of most prefixes, and so the pairs of such texts.  Half as
    much again of each set is counted, as others move up.
    """

    def run(batches):
        none = np.empty(0, np.uint64)
        for batch in batches:
            sets = [shingle_set(t, size) for t in _texts(batch.column(0))]
            parts = [x[: len(_prefix(x, similarity, none)) * 3 // 2].view(np.int64) for x in sets]
            yield pa.RecordBatch.from_arrays([numbers(np.concatenate([none.view(np.int64), *parts]))], names=["token"])

    counted = keyed.select("text").mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n"))
    most = counted.where(F.col("n") > FREQUENT_FROM).orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").collect()
    return np.sort(np.array([r.token for r in most], dtype=np.int64).view(np.uint64))


def _xor_bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def _set_prints(batches, size: int, similarity: float, frequent: np.ndarray):
    """``(id, text_key, node, fp, n, prefix, bits)`` of every row; ``node`` names the shingle set, ``fp`` is its SimHash."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            nodes, fps, sizes, prefixes, bits, wide = [], [], [], [], [], []
            for text in part.column(1).cast(pa.binary()).to_pylist():
                shingles = shingle_set(text, size)
                nodes.append(_set_key(shingles))
                fps.append(_set_fingerprint(shingles))
                sizes.append(len(shingles))
                prefixes.append(_prefix(shingles, similarity, frequent).view(np.int64))
                bits.append(_xor_bitmap(shingles, 64 * BITMAP).view(np.int64))
                wide.append(_xor_bitmap(shingles, WIDE).tobytes() if len(shingles) > WIDE_FROM else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), numbers(nodes), numbers(fps), numbers(sizes), lists(prefixes), lists(bits), binaries(wide),
                ],
                names=["id", "text_key", "node", "fp", "n", "prefix", "bits", "wide"],
            )


def _may_reach(similarity: float) -> Column:
    """Whether members ``x`` and ``y`` can reach ``similarity``: exact bounds, no true pair fails.

    Sizes bound the similarity, and differing bits of the XOR bitmaps never
    outnumber the shingles of only one side.
    """
    x, y = F.col("x.n"), F.col("y.n")
    differing = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BITMAP)), F.lit(0))
    return (F.least(x, y) + 1e-6 >= similarity * F.greatest(x, y)) & (differing * (1 + similarity) <= (1 - similarity) * (x + y) + 1e-6)


def _thinned(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """``pairs(a, b)`` without those of long texts whose wide bitmaps differ too much; no true pair goes."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y, total in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True):
                if not (x.is_valid and y.is_valid):
                    keep.append(True)
                    continue
                x, y = (np.frombuffer(b.as_buffer(), dtype=np.uint64) for b in (x, y))
                keep.append(int(np.bitwise_count(x ^ y).sum()) * (1 + similarity) <= (1 - similarity) * total + 1e-6)
            yield batch.select([0, 1]).filter(flags(keep))

    wide = nodes.where("wide is not null")
    both = pairs.join(wide.select(F.col("node").alias("a"), F.col("wide").alias("x"), F.col("n").alias("xn")), "a", "left")
    both = both.join(wide.select(F.col("node").alias("b"), F.col("wide").alias("y"), F.col("n").alias("yn")), "b", "left")
    return both.select("a", "b", "x", "y", (F.col("xn") + F.col("yn")).alias("total")).mapInArrow(run, "a long, b long")


def _reaching(batches, similarity: float):
    """The pairs whose shingle sets reach ``similarity``."""
    for batch in batches:
        good = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
        yield batch.select([0, 1]).filter(flags(good))


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` whose texts' shingle sets reach ``similarity``."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = cut(ends.join(nodes.select("node", "text_key"), "node"))
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, size) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            same = flags([_set_key(s) == node for s, node in zip(sets, batch.column(0).to_pylist(), strict=True)])
            out = pa.RecordBatch.from_arrays([batch.column(0), binaries([s.tobytes() for s in sets])], names=["node", "shingles"])
            yield out.filter(same)

    texts = rows.join(wanted, "text_key").select("node", "text")
    sets = stored(texts.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"]), "shingles")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y")
    out = cut(both.mapInArrow(lambda b: _reaching(b, similarity), "a long, b long"))
    discard(sets)
    return out


def indexed_pairs(nodes: DataFrame, similarity: float, distance: int = 3) -> DataFrame:
    """Pairs ``(a, b)`` of sets that the byte-position index links by their fingerprints and that can reach ``similarity``.

    A fingerprint stands for its smallest set; others that have the same one
    are paired with that set, so a group of near copies makes no square.
    """
    hubs = cut(nodes.groupBy("fp").agg(F.min_by(F.struct("node", "n", "bits"), "node").alias("x")))
    found = links(hubs.select("fp"), distance)
    across = found.join(hubs.toDF("a", "x"), "a").join(hubs.toDF("b", "y"), "b").select("x", "y")
    within = nodes.join(hubs, "fp").where(F.col("node") != F.col("x.node")).select("x", F.struct("node", "n", "bits").alias("y"))
    return across.unionByName(within).where(_may_reach(similarity)).select(*_pair())


def _pair() -> list[Column]:
    return [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]


def similar_links(rows: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame | None:
    """Verified links ``(a, b)`` that join what all pairs of ``similarity`` join; None if there are none.

    Candidates are the pairs of the byte-position index first.  It has those of
    close fingerprints only, so prefix filtering adds the rest; its postings are
    the prefixes' shingles.  Every member of a list is compared with the list's
    hub, which joins groups of near copies without their pairs; then all pairs
    of a list that these links have not joined.
    """
    indexed = indexed_pairs(nodes, similarity)
    postings = nodes.select(F.explode("prefix").alias("token"), "node")
    # A member has company if the list goes on before or after it: one shuffle of (token, node), and most tokens end here.
    by_token = Window.partitionBy("token").orderBy("node")
    listed = postings.select("token", "node", F.coalesce(F.lag("node").over(by_token), F.lead("node").over(by_token)).alias("other"))
    postings = cut(listed.where("other is not null").select("token", "node").join(nodes.select("node", "n", "bits"), "node"))
    reach, pair = _may_reach(similarity), _pair()

    # Another hub for each shingle: where it has only a passage in common with the others, other lists have better ones.
    ranked = Window.partitionBy("token").orderBy(F.xxhash64("token", "node"), "node")
    hub = F.first(F.struct("node", "n", "bits")).over(ranked)
    spokes = postings.select("token", F.struct("node", "n", "bits").alias("x"), hub.alias("y")).where((F.col("x.node") != F.col("y.node")) & reach)
    tested = cut(_thinned(indexed.unionByName(spokes.select(*pair)).distinct(), nodes, similarity))
    edges = None if tested.isEmpty() else _verified(tested, nodes, rows, size, similarity)
    if edges is None:
        grouped = postings.withColumn("group", F.col("node"))
    else:
        groups = components(edges)
        if groups.count() <= BROADCAST_NODES:
            groups = F.broadcast(groups)
        grouped = postings.join(groups, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")

    # Both sides are one exchange; AQE splits a list that outgrows its task.
    x, y = grouped.alias("x"), grouped.alias("y")
    rest = x.join(y, [F.col("x.token") == F.col("y.token"), F.col("x.node") < F.col("y.node"), F.col("x.group") != F.col("y.group"), reach])
    rest = rest.select(*pair).distinct().join(tested, ["a", "b"], "left_anti")
    rest = cut(_thinned(rest, nodes, similarity))
    discard(postings)
    if rest.isEmpty():
        return edges
    more = _verified(rest, nodes, rows, size, similarity)
    return more if edges is None else edges.unionByName(more)


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``id_col, text_key, component`` for every row: components of all pairs that reach ``similarity``.

    Similarity is the Jaccard index of the sets of ``shingle_words`` shingles.
    Sets get SimHash fingerprints, and the byte-position index gives the pairs
    within three bits.  At 0.8 fingerprints of 64 bits differ in about ten bits
    and share no guaranteed byte, so prefix filtering adds what the index
    cannot have, and no pair is lost: sets of similarity s share one of the
    ``n - ceil(s n) + 1`` first shingles of each, in any order common to all
    sets.  Every link is verified on the sets themselves.
    ``text_key`` orders the rows of one id.  Null and wordless texts are one
    group; other rules are those of ``near_duplicates``.
    """
    if not 0.5 <= similarity <= 1:
        raise ValueError("similarity must lie between 0.5 and 1")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    ddl = "id long, text_key long, node long, fp long, n long, prefix array<long>, bits array<long>, wide binary"
    often = docs.sparkSession.sparkContext.broadcast(frequent_shingles(keyed, shingle_words, similarity))
    prints = stored(keyed.mapInArrow(lambda b: _set_prints(b, shingle_words, similarity, often.value), ddl), "prints")
    nodes = stored(prints.drop("id").dropDuplicates(["node"]), "nodes")
    edges = similar_links(keyed.select("text_key", "text"), nodes, shingle_words, similarity)
    discard(nodes)
    named = prints.select(F.col("id").alias(id_col), "text_key", "node")
    if edges is None:
        return named.withColumnRenamed("node", "component")
    return named.join(components(edges), "node", "left").select(id_col, "text_key", F.coalesce("root", "node").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that ``edges(a, b)`` names; root is one per component.

    Randomised contraction: in each round a node moves to the neighbour (or
    itself) with the smallest hash under the round's seed.
    """
    edges = cut(edges.select("a", "b").where("a <> b"))
    moved: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("v"))
        step = cut(
            both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("best"))
            .select(F.col("a").alias("node"), F.least(rank(F.col("a")), F.col("best"))["v"].alias("to"))
        )
        if moved is None:
            moved = step.select("node", F.col("to").alias("root"))
        else:
            moved = cut(
                moved.join(step.withColumnRenamed("node", "root"), "root", "left")
                .select("node", F.coalesce("to", "root").alias("root"))
            )
        at_a, at_b = step.toDF("a", "ta"), step.toDF("b", "tb")
        edges = cut(
            edges.join(at_a, "a").join(at_b, "b").where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        )
    if moved is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return moved


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    distance: int = 3,
    max_postings: int = 512,
) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``distance`` differing bits, the row's own included.  Null and wordless
    texts have fingerprint zero and link like any other.  Repeated rows give
    repeated rows; a null id stays null and never becomes a component's id
    while the component has another (a component of null ids only has null).
    An empty table gives an empty result.  Other columns, whatever their names, are ignored.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle_words))
    firsts = cut(prints.groupBy("fp").agg(F.min("id").alias("first")))
    found = components(links(firsts.select("fp"), distance, max_postings))
    # Copies share a fingerprint, so only one row of each takes part below.
    named = firsts.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    merged = named.join(least, "root").select("fp", "component_id")
    return prints.join(merged, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
