"""Token counts under a unigram model, by dynamic programming over a shared trie.

A pre-token is a word (no ASCII white space) after the mark U+2581.  Its count
is the number of pieces in its most probable segmentation.  Forward scores
depend on the prefix alone, so distinct pre-tokens are inserted into one trie
and each node's best score and count are worked out once, from the pieces that
end there; a node also keeps the positions from which its prefix can still
grow into a piece, so that no other substrings are looked up.  The node where a
pre-token ends stores its count.  Documents then
add up the counts of their words.  Every task keeps a trie of bounded size:
nothing is shuffled, and starting it afresh changes no count.

The vocabulary is that of a public tokenizer file.  It gives an order but no
probabilities: piece number r gets Zipf's, ``-log(r + 1)``, in whole millionths.
Characters without a piece fall back to their UTF-8 bytes.  Of equally
probable segmentations the shortest counts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import bound_batches

MARK = "▁"
MAX_NODES = 1_000_000
CACHE_WORDS = 500_000


def load_pieces(model_path: str) -> dict[str, int]:
    """Piece -> score in millionths of a nat, from a sentencepiece file; None is the score of a fallback byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    normal = [model.id_to_piece(i) for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces: dict = {p: -round(1e6 * math.log(r + 2)) for r, p in enumerate(normal)}
    pieces[None] = -round(1e6 * (math.log(len(normal) + 2) + 10))
    return pieces


class Trie:
    """Forward scores and counts of every prefix of the pre-tokens inserted."""

    def __init__(self, pieces: dict):
        self.byte_score = pieces[None]
        # Every prefix of a piece; those that are no piece themselves have the score of the impossible.
        self.starts: dict[str, float] = {p[:n]: -math.inf for p in pieces if p is not None for n in range(1, len(p))}
        self.starts.update((p, s) for p, s in pieces.items() if p is not None)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.tokens = [0], [0]
        self.growing: list[tuple[int, ...]] = [()]
        self.terminal: dict[bytes, int] = {}

    def insert(self, word: bytes) -> int:
        """The count of one word; only nodes that are new are worked out."""
        text = MARK + word.decode()
        child, score, tokens, growing, known = self.child, self.score, self.tokens, self.growing, self.starts.get
        node, path = 0, [0]
        for end, c in enumerate(text, start=1):
            key = node << 21 | ord(c)
            if (to := child.get(key)) is None:
                size = len(c.encode())
                best = score[node] + size * self.byte_score
                fewest = tokens[node] + size
                live = []
                for begin in (*growing[node], end - 1):
                    if (s := known(text[begin:end])) is not None:
                        live.append(begin)
                        at = path[begin]
                        s += score[at]
                        if s >= best and (s > best or tokens[at] + 1 < fewest):
                            best, fewest = s, tokens[at] + 1
                to = child[key] = len(score)
                score.append(best)
                tokens.append(fewest)
                growing.append(tuple(live))
            node = to
            path.append(node)
        self.terminal[word] = tokens[node]
        return tokens[node]

    def count(self, text: bytes) -> tuple[int, int]:
        """``(words, tokens)`` of a whole text."""
        words = text.split()
        total = 0
        for lo in range(0, len(words), 100_000):
            part = words[lo : lo + 100_000]
            found = list(map(self.terminal.get, part))
            if None in found:
                if len(self.score) > MAX_NODES or len(self.terminal) > CACHE_WORDS:
                    self.clear()
                    found = [None] * len(part)
                missing = {w for w, n in zip(part, found, strict=True) if n is None}
                for word in sorted(missing):
                    self.insert(word)
                found = list(map(self.terminal.__getitem__, part))
            total += sum(found)
        return len(words), total


_tries: dict[int, Trie] = {}


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, n_words, n_tokens``.

    Null and empty texts have none of either.  Repeated rows give repeated
    rows, ids may be null, an empty table gives none, other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(load_pieces(model_path))  # a vocabulary: fixed size

    @F.arrow_udf("struct<n_words:bigint,n_tokens:bigint>")
    def counted(texts: pa.Array) -> pa.Array:
        key = id(sent.value)
        if key not in _tries:
            _tries.clear()
            _tries[key] = Trie(sent.value)
        counts = [_tries[key].count(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
        columns = np.array(counts, dtype=np.int64).reshape(-1, 2)
        return pa.StructArray.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["n_words", "n_tokens"])

    return docs.select(F.col(id_col), counted(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("c")).select(id_col, "c.n_words", "c.n_tokens")
