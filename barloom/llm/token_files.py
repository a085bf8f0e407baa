"""Token ids in binary files: patched frame-of-reference blocks with an index.

Documents are dealt by range of their id and sorted, so that the files hold
them in ascending order.  Each task writes one *shard* (a Parquet file, so
that Spark's committer protects it against lost executors) of *segments*.  A
segment holds whole documents and cuts their ids into blocks of 1024:

* the block's minimum is subtracted (frame of reference);
* the rest is packed at the width of the block's 95th percentile;
* ids that need more bits leave their low bits there, and their position and
  high bits go to the segment's exception lists;
* ``block_offsets`` indexes where each block starts in ``payload``.

Reading needs no shuffle: every segment knows its start within its shard and a
manifest of one row per shard has the ids before it.

Ids come from the tokenizers library alone; see ``_Encoder`` for what is
encoded once instead of every time.
"""

from __future__ import annotations

import gc
import json
import os
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm._arrow import binaries, items, lists, numbers
from barloom.llm._spark import bound_batches, fresh_path, give_back, in_use, shared_dir

BLOCK = 1024
SEGMENT_IDS = 1 << 17
PERCENTILE = 95.0
#: Distinct runs of letters, marks and other words kept by one Python worker, in each of two generations.
CACHE_WORDS = 1_000_000

SEGMENTS = pa.schema(
    [
        ("shard", pa.int32()),
        ("seq", pa.int32()),
        ("first", pa.int64()),
        ("n_values", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("bases", pa.list_(pa.int64())),
        ("widths", pa.list_(pa.int32())),
        ("block_offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
        ("patch_at", pa.list_(pa.int32())),
        ("patch_high", pa.list_(pa.int64())),
    ]
)
_SEGMENTS_DDL = (
    "shard int, seq int, first long, n_values long, doc_ids array<long>, lengths array<long>, bases array<long>,"
    " widths array<int>, block_offsets array<long>, payload binary, patch_at array<int>, patch_high array<long>"
)


# -- the codec ---------------------------------------------------------------


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2**width`` as rows of bytes."""
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(*values.shape, 4), axis=2)
    return np.packbits(bits[:, :, 32 - width :].reshape(len(values), -1), axis=1)


def _unpack(packed: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, count=n * width).reshape(len(packed), n, width)
    whole = np.zeros((len(packed), n, 32), dtype=np.uint8)
    whole[:, :, 32 - width :] = bits
    return np.packbits(whole, axis=2).view(">u4").reshape(len(packed), n).astype(np.uint32)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> dict:
    """The block columns of one segment for a flat array of unsigned 32-bit ids."""
    ids = np.asarray(ids, dtype=np.uint32)
    full = len(ids) // BLOCK
    parts = [ids[: full * BLOCK].reshape(full, BLOCK)] if full else []
    if len(ids) % BLOCK:
        parts.append(ids[full * BLOCK :].reshape(1, -1))
    bases, widths, rows, patch_at, patch_high, at = [], [], [], [], [], 0
    for part in parts:
        base = part.min(axis=1)
        rest = part - base[:, None]
        chosen = np.percentile(rest, percentile, axis=1, method="higher").astype(np.uint64)
        width = np.maximum(1, np.ceil(np.log2(chosen + np.uint64(1)))).astype(int)
        high = rest.astype(np.uint64) >> width[:, None].astype(np.uint64)
        row, col = np.nonzero(high)
        patch_at.append(at + row * BLOCK + col)
        patch_high.append(high[row, col])
        packed = np.empty(len(part), dtype=object)
        for w in np.unique(width):
            same = np.flatnonzero(width == w)
            low = rest[same] & np.uint32((1 << int(w)) - 1)
            for i, line in zip(same, _pack(low, int(w)), strict=True):
                packed[i] = line.tobytes()
        bases.append(base)
        widths.append(width)
        rows += list(packed)
        at += part.size
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
    return {
        "bases": join(bases, np.int64),
        "widths": join(widths, np.int32),
        "block_offsets": np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]]).astype(np.int64) if rows else np.empty(0, np.int64),
        "payload": b"".join(rows),
        "patch_at": join(patch_at, np.int32),
        "patch_high": join(patch_high, np.int64),
    }


def decode_blocks(n_values: int, blocks: dict, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of blocks ``first_block`` to ``last_block`` (all by default), found through the index."""
    widths, offsets, payload = blocks["widths"], blocks["block_offsets"], np.frombuffer(blocks["payload"], np.uint8)
    last_block = len(widths) if last_block is None else last_block
    ends = np.append(offsets[1:], len(payload))
    stop = min(n_values, last_block * BLOCK)
    out = np.empty(max(0, stop - first_block * BLOCK), dtype=np.uint32)
    counts = np.minimum(BLOCK, n_values - np.arange(len(widths)) * BLOCK)
    chosen = np.arange(first_block, last_block)
    for w, n in {(int(widths[b]), int(counts[b])) for b in chosen}:
        same = chosen[(widths[chosen] == w) & (counts[chosen] == n)]
        packed = np.stack([payload[offsets[b] : ends[b]] for b in same])
        values = _unpack(packed, w, n)
        for b, line in zip(same, values, strict=True):
            lo = (b - first_block) * BLOCK
            out[lo : lo + n] = line
    at = blocks["patch_at"]
    mine = (at >= first_block * BLOCK) & (at < stop)
    spots = at[mine] - first_block * BLOCK
    shift = widths[at[mine] // BLOCK].astype(np.uint64)
    out[spots] |= (blocks["patch_high"][mine].astype(np.uint64) << shift).astype(np.uint32)
    if len(out):
        out += np.repeat(blocks["bases"][chosen], counts[chosen]).astype(np.uint32)
    return out


# -- encoding ----------------------------------------------------------------


def _nones(row: list):
    i = -1
    try:
        while True:
            i = row.index(None, i + 1)
            yield i
    except ValueError:
        return


#: A run of Latin letters and the marks after it: two pre-tokens for tokenizers with word ends.
_WORD = r"^(?P<run>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
#: Missing runs of letters given to the library as one text.
_JOINED = 256
#: Bytes of the texts that are encoded together, each of their words once; fewer for a small cache: those
#: of a word kept, as a group should not hold many more distinct words than the cache.
_AT_ONCE = 4 << 20
_AT_ONCE_A_WORD = 25


def _word_ends(spec: str) -> np.ndarray:
    """Which ids end a pre-token, where the tokenizer treats words alike wherever they stand; else empty."""
    from tokenizers import Tokenizer

    parsed = json.loads(spec)
    suffix = parsed["model"].get("end_of_word_suffix")
    steps = [n["type"] for n in (parsed.get("normalizer") or {}).get("normalizers", [])]
    cuts = [(c["type"], c.get("behavior"), c.get("add_prefix_space")) for c in (parsed.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    if not suffix or steps != ["NFC", "Replace", "Lowercase"] or cuts != [("Split", "Removed", None), ("ByteLevel", None, False)]:
        return np.zeros(0, dtype=bool)
    tokenizer = Tokenizer.from_str(spec)
    ends = np.zeros(tokenizer.get_vocab_size(), dtype=bool)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        ends[i] = token.endswith(suffix)
    return ends


class _Encoder:
    """Ids of a text as little-endian bytes.

    Where the tokenizer lower-cases, drops white space and marks the end of
    every pre-token, the distinct words of many texts are cut into runs of
    letters and the marks after them.  Runs, marks and all other words are
    encoded once and kept in two generations of a bounded cache, and runs go
    many to a call: the tokens with the end mark say where each run ends.
    Other tokenizers get whole texts.
    """

    def __init__(self, spec: str, cache_words: int = CACHE_WORDS, ends: np.ndarray | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(spec)
        self.ends = _word_ends(spec) if ends is None else ends
        self.by_word = len(self.ends) > 0
        self.cache_words = cache_words
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in done]

    def _runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """Ids of runs of lower-case letters, each one pre-token."""
        out: dict[bytes, bytes] = {}
        for k in range(0, len(runs), _JOINED):  # the library's answers are large: one at a time
            group = runs[k : k + _JOINED]
            done = self.tokenizer.encode_batch_fast([b" ".join(group).decode()], add_special_tokens=False)[0]
            ids = np.array(done.ids, dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            raw = ids.tobytes()
            if len(stops) != len(group):  # not the boundaries expected: one by one
                out.update(zip(group, self._whole([r.decode() for r in group]), strict=True))
                continue
            lo = 0
            for run, hi in zip(group, stops.tolist(), strict=True):
                out[run] = raw[lo:hi]
                lo = hi
        return out

    def _known(self, others: list[bytes], runs: list[bytes]) -> list[bytes]:
        """Ids of marks and words, then of runs; what no generation has is learned, and the first of it kept: frequent words come early."""
        keys = others + runs
        row = list(map(self.young.get, keys))
        gaps = list(_nones(row))
        for i in gaps:
            row[i] = self.old.get(keys[i])
        new = [i for i in gaps if row[i] is None]
        if new:
            found = self._runs([keys[i] for i in new if i >= len(others)])
            new = [i for i in new if i < len(others)]
            found.update(zip([keys[i] for i in new], self._whole([keys[i].decode(errors="replace") for i in new]), strict=True))
            row = [found[key] if ids is None else ids for key, ids in zip(keys, row, strict=True)]
        kept = gaps[: self.cache_words]
        if len(self.young) + len(kept) > self.cache_words:
            self.old, self.young = self.young, {}
        self.young.update((keys[i], row[i]) for i in kept)
        return row

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._whole([t.decode(errors="replace") for t in texts])
        split = pc.ascii_split_whitespace(binaries(texts).view(pa.string()))
        words = split.values.dictionary_encode()
        cut = pc.extract_regex(words.dictionary, pattern=_WORD)  # null for words that are not cut
        runs = pc.utf8_lower(pc.struct_field(cut, "run")).dictionary_encode()  # of these letters, one at a time or together, are the same
        marks = pc.struct_field(cut, "marks").dictionary_encode()
        uncut = cut.is_null()
        others = items(marks.dictionary) + items(words.dictionary.filter(uncut))
        row = self._known(others, items(runs.dictionary))
        mark_ids = binaries(row[: len(marks.dictionary)]).take(marks.indices)
        run_ids = binaries(row[len(others) :]).take(runs.indices)
        nothing = binaries([b""])[0]
        ids = pc.binary_join_element_wise(run_ids, mark_ids, nothing)
        ids = pc.replace_with_mask(ids, uncut, binaries(row[len(marks.dictionary) : len(others)]))
        return items(ids.take(words.indices), split)


_encoders: dict[str, _Encoder] = {}


def _encoder(spec: str, ends: np.ndarray, cache_words: int) -> _Encoder:
    key = f"{cache_words} {md5(spec.encode()).hexdigest()}"
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = _Encoder(spec, cache_words, ends)
        give_back()  # parsing took more than the tokenizer holds
    return _encoders[key]


def _segments(batches, spec: str, ends: np.ndarray, end_id: int, cache_words: int):
    before = gc.get_threshold()
    gc.set_threshold(200_000)  # nothing here makes cycles, and collections walk the lists of a batch
    try:
        with in_use(_encoders):
            yield from _encoded_segments(batches, _encoder(spec, ends, cache_words), end_id)
    finally:
        gc.set_threshold(*before)
        give_back()


def _id_list(ids: list[int | None]) -> pa.Array:
    """One list of ids, any of them null."""
    known = np.fromiter((i is not None for i in ids), dtype=bool, count=len(ids))
    flat = np.fromiter((i or 0 for i in ids), dtype=np.int64, count=len(ids))
    child = pa.Array.from_buffers(pa.int64(), len(ids), [pa.py_buffer(np.packbits(known, bitorder="little")), pa.py_buffer(flat)])
    return pa.Array.from_buffers(pa.list_(pa.int64()), 1, [None, pa.py_buffer(np.array([0, len(ids)], dtype=np.int32))], children=[child])


def _groups(batches, at_once: int):
    """Ids and texts of the rows; a group ends with the text that brings it to ``at_once`` bytes."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        raw = batch.column(1).cast(pa.binary())
        for lo in range(0, batch.num_rows, 256):
            for doc_id, text in zip(batch.column(0).slice(lo, 256).to_pylist(), raw.slice(lo, 256).to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= at_once:
                    yield doc_ids, texts
                    doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def _encoded_segments(batches, encoder: _Encoder, end_id: int):
    shard = TaskContext.get().partitionId()
    end = np.array([end_id], dtype="<u4").tobytes()
    seq = first = held = 0
    doc_ids, parts = [], []

    def segment():
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        blocks = encode_blocks(ids)
        columns = [numbers([shard], np.int32), numbers([seq], np.int32), numbers([first]), numbers([len(ids)]), _id_list(doc_ids), lists([[len(p) // 4 for p in parts]])]
        columns += [lists([blocks["bases"]]), lists([blocks["widths"]], np.int32), lists([blocks["block_offsets"]]), binaries([blocks["payload"]])]
        columns += [lists([blocks["patch_at"]], np.int32), lists([blocks["patch_high"]])]
        return pa.RecordBatch.from_arrays(columns, schema=SEGMENTS)

    for some, texts in _groups(batches, min(_AT_ONCE, _AT_ONCE_A_WORD * encoder.cache_words)):
        for doc_id, ids in zip(some, encoder.encode(texts), strict=True):
            doc_ids.append(doc_id)
            parts.append(ids + end)
            held += len(ids) // 4 + 1
            if held >= SEGMENT_IDS:
                yield segment()
                seq, first, held, doc_ids, parts = seq + 1, first + held, 0, [], []
        give_back()
    if parts:
        yield segment()


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", cache_words: int = CACHE_WORDS
) -> DataFrame:
    """Writes ``path/segments`` and ``path/manifest``; returns the manifest ``(shard, n_values, base)``.

    Documents go in ascending id order, null ids first; rows with one id are
    ordered by their text's hash, and repeated rows are all kept.  Null texts
    are empty; every document ends in ``end_id``.  An empty table writes an
    empty segment folder and an empty manifest.  ``cache_words`` bounds each
    generation of a worker's cache of words; it changes no result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    # A vocabulary file: fixed size.  It is parsed here, once, so that workers hold no more than the tokenizer.
    sent = spark.sparkContext.broadcast((spec, _word_ends(spec)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The last two keys only split many rows of one id between tasks.
    keyed = rows.withColumn("tie", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    dealt = keyed.repartitionByRange("id", "tie", "part").sortWithinPartitions("id", "tie")
    dealt.select("id", "text").mapInArrow(lambda b: _segments(b, *sent.value, end_id, cache_words), _SEGMENTS_DDL).write.parquet(f"{path}/segments")
    shards = spark.read.parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_values").alias("n"))
    base, manifest = 0, []
    for r in sorted(shards.collect()):  # one row per written file
        manifest.append((r.shard, r.n, base))
        base += r.n
    shard, n_values, bases = zip(*manifest, strict=True) if manifest else ((), (), ())
    # An Arrow table: a list would be read by Python workers of their own, and those stay for a minute.
    table = pa.table({"shard": numbers(shard, np.int32), "n_values": numbers(n_values), "base": numbers(bases)})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def _documents(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            blocks = {k: np.asarray(row[k].values) for k in ("bases", "widths", "block_offsets", "patch_at", "patch_high")}
            ids = decode_blocks(row["n_values"].as_py(), blocks | {"payload": row["payload"].as_py()})
            raw = ids.astype("<u4").tobytes()
            lengths = np.asarray(row["lengths"].values, dtype=np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            tokens = binaries([raw[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].values, numbers(starts + row["base"].as_py() + row["first"].as_py()), numbers(lengths), tokens],
                names=["id", "start", "n_tokens", "token_ids"],
            )


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, token_ids)`` of every document in the files at ``path``.

    ``start`` counts the ids before the document over all shards; ``token_ids``
    is binary, four little-endian bytes an id.
    """
    segments = spark.read.parquet(f"{path}/segments").drop("seq")
    manifest = spark.read.parquet(f"{path}/manifest").select("shard", "base")
    return (
        segments.join(F.broadcast(manifest), "shard")  # one row per written file
        .mapInArrow(_documents, "id long, start long, n_tokens long, token_ids binary")
        .withColumnRenamed("id", id_col)
    )


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 1, cache_words: int = CACHE_WORDS, **columns: str) -> DataFrame:
    """Writes the files to a new folder of the shared directory and reads them back."""
    spark = docs.sparkSession
    shared_dir(spark)
    path = fresh_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id, cache_words=cache_words, **columns)
    return read_token_files(spark, path, columns.get("id_col", "doc_id"))
