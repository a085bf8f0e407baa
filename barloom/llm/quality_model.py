"""A quality classifier on supervised subword embeddings.

Every word stands for itself and for its character n-grams (``<`` and ``>``
mark its ends), and every two neighbouring words for their bigram, all hashed
into one table of learned vectors.  A document is the mean of the vectors of
all its features, a softmax over it the output.  A word has some ten features
and a bigram is one, so bigrams count ``PAIR_WEIGHT`` times in the mean.
Training is numpy stochastic gradient descent over a bounded sample of
labelled rows, in one task on an executor; only the trained table reaches the
driver.  Since mean and output are linear, scoring needs one number a feature,
and that of a word is kept in a bounded cache: no text is cut.  Bytes that are
not UTF-8 read as U+FFFD.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import bound_batches

#: Fixed shape of the model; the table has BUCKETS rows whatever the input.
BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
EPOCHS = 8
RATE = 1.0
#: Labelled rows that training uses, those with the smallest hash of their id.
TRAIN_ROWS = 3000
CACHE_WORDS = 400_000
#: Words looked up at once.
PART = 100_000
#: How often a word bigram counts in a document's mean.
PAIR_WEIGHT = 8

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _buckets(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((key ^ (key >> np.uint64(29))) & np.uint64(BUCKETS - 1)).astype(np.int64)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers of all features of all words, flat, how many each word has (at least one), and each word's own key."""
    spelled = [w.decode(errors="replace") for w in words]
    text = "".join([f"<{w}>" for w in spelled])
    chars = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in spelled), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(chars))  # characters up to the word's end
    keys, owners = [], []
    for n in GRAMS:
        count = len(chars) - n + 1
        if count <= 0:
            continue
        gram = np.full(count, n, dtype=np.uint64)
        for i in range(n):
            gram = gram * _STEP + chars[i : i + count]
        inside = left[:count] >= n
        keys.append(gram[inside])
        owners.append(owner[:count][inside])
    sums = np.zeros(len(chars) + 1, dtype=np.uint64)  # the word itself, by a polynomial from its start
    place = np.arange(len(chars)) - np.repeat(starts, sizes)
    powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(max(sizes.max(initial=1) - 1, 0), _STEP)]).astype(np.uint64))
    np.cumsum(chars * powers[place], out=sums[1:])
    own_keys = sums[ends] - sums[starts] + np.uint64(77)
    keys.append(own_keys)
    owners.append(np.arange(len(words)))
    key, own = np.concatenate(keys), np.concatenate(owners)
    return _buckets(key)[np.argsort(own, kind="stable")], np.bincount(own, minlength=len(words)), own_keys


def pair_features(keys: np.ndarray) -> np.ndarray:
    """Bucket numbers of the bigrams of words with these keys, in order."""
    first = keys[:-1]
    return _buckets((first ^ (first >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD) + keys[1:])


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares of its features."""
    words = text.split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    distinct: dict[bytes, int] = {}
    at = np.fromiter((distinct.setdefault(w, len(distinct)) for w in words), dtype=np.int64, count=len(words))
    buckets, sizes, keys = word_features(list(distinct))
    total = np.bincount(buckets, weights=np.repeat(np.bincount(at), sizes), minlength=BUCKETS)
    total += PAIR_WEIGHT * np.bincount(pair_features(keys[at]), minlength=BUCKETS)
    used = np.flatnonzero(total)
    return used, (total[used] / total.sum()).astype(np.float32)


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> tuple[np.ndarray, float]:
    """``(slope, bias)``: one number a bucket, and the constant, of the log odds of label 1.

    Classes weigh alike.  Without both classes the log odds are constant.
    """
    y = np.array(labels, dtype=np.int64)
    share = (y.sum() + 1) / (len(y) + 2)
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), dtype=np.float32), np.zeros(2, dtype=np.float32)
    docs = [document_features(t) for t in texts]
    weight = np.array([0.5 / (1 - y.mean()), 0.5 / y.mean()], dtype=np.float32)
    step, steps = 0, EPOCHS * len(docs)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            used, part = docs[i]
            hidden = part @ vectors[used]
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]] * rate
            back = p @ out
            out -= np.outer(p, hidden)
            bias -= p
            # Shares are tiny: the mean's gradient is spread over the document's features.
            vectors[used] -= (part / max(part.max(initial=0), 1e-12))[:, None] * back
    slope = vectors @ (out[1] - out[0])
    return slope.astype(np.float64), float(bias[1] - bias[0])


class Scorer:
    """Probability of label 1 for whole texts."""

    def __init__(self, slope: np.ndarray, bias: float):
        self.slope, self.bias = slope, bias
        self.known: dict[bytes, int] = {}  # word -> its row of the arrays
        self.sums = np.empty(CACHE_WORDS + PART)
        self.sizes = np.empty(CACHE_WORDS + PART, dtype=np.int64)
        self.keys = np.empty(CACHE_WORDS + PART, dtype=np.uint64)

    def _learn(self, words: list[bytes]) -> None:
        buckets, sizes, keys = word_features(words)
        lo = len(self.known)
        hi = lo + len(words)
        self.sums[lo:hi] = np.add.reduceat(self.slope[buckets], np.cumsum(sizes) - sizes)
        self.sizes[lo:hi], self.keys[lo:hi] = sizes, keys
        self.known.update(zip(words, range(lo, hi), strict=True))

    def score(self, texts: list[bytes]) -> np.ndarray:
        sums, sizes = np.zeros(len(texts)), np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = text.split()
            last = np.empty(0, dtype=np.uint64)  # the word before this part
            for lo in range(0, len(words), PART):
                part = words[lo : lo + PART]
                found = list(map(self.known.get, part))
                if None in found:
                    missing = {w for w, v in zip(part, found, strict=True) if v is None}
                    if len(self.known) + len(missing) > CACHE_WORDS:
                        self.known, missing = {}, set(part)
                    self._learn(list(missing))
                    found = list(map(self.known.__getitem__, part))
                at = np.array(found)
                keys = np.concatenate([last, self.keys[at]])
                pairs = self.slope[pair_features(keys)]
                sums[i] += self.sums[at].sum() + PAIR_WEIGHT * pairs.sum()
                sizes[i] += self.sizes[at].sum() + PAIR_WEIGHT * len(pairs)
                last = keys[-1:]
        odds = self.bias + sums / np.maximum(sizes, 1)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


_scorers: dict[bytes, Scorer] = {}


def _scorer(model: bytes) -> Scorer:
    if model not in _scorers:
        _scorers.clear()
        values = np.frombuffer(model, dtype=np.float64)
        _scorers[model] = Scorer(values[1:], float(values[0]))
    return _scorers[model]


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _fit(batches, seed: int):
    texts, labels = [], []
    for batch in batches:
        texts += _texts(batch.column(0))
        labels += batch.column(1).to_pylist()
    slope, bias = train(texts, labels, seed)
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[bias], slope]).tobytes()], type=pa.binary())], names=["model"])


def held_out(id_col: str, folds: int = 5) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_rows: int = TRAIN_ROWS,
    seed: int = 7,
) -> bytes:
    """The model as bytes: bias, then the slope of every bucket, as little-endian doubles.

    Learns from labelled rows that are not held out, at most ``train_rows`` of
    them (smallest hash of their id first), whole texts.  Null ids and null
    labels teach nothing; an id with several labels counts as its largest.
    Without labelled rows every score is one half.
    """
    bound_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
    known = known.where(~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    # The sample is drawn from ids alone; only its texts are then looked up.
    drawn = known.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(train_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(drawn), "id").orderBy("id", F.xxhash64("text"), "text").limit(train_rows).select("text", "label")
    model = sample.coalesce(1).mapInArrow(lambda b: _fit(b, seed), "model binary").collect()
    return bytes(model[0].model) if model else np.zeros(BUCKETS + 1).tobytes()


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``id_col, held_out, score, predicted`` for every input row, from the whole text alone.

    Empty and null texts get the score of no features; repeated rows get equal
    scores; an empty table gives none; other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS + 1 doubles

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        raw, scorer = _texts(texts), _scorer(sent.value)
        return pa.array(np.concatenate([scorer.score(raw[i : i + 256]) for i in range(0, len(raw), 256)]) if raw else [], type=pa.float64())

    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("score"))
    return rows.select(id_col, "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
