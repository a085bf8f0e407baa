import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from barloom.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
PIECES = token_counts.load_pieces(PATH)


def brute(word, pieces):
    """``(score, -tokens)`` of the best segmentation, from scratch for each word."""
    text = token_counts.MARK + word
    best = [(0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        n = len(text[end - 1].encode())
        options = [(best[end - 1][0] + n * pieces[None], best[end - 1][1] - n)]
        options += [(best[b][0] + pieces[text[b:end]], best[b][1] - 1) for b in range(end) if text[b:end] in pieces]
        best[end] = max(options)
    return best[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcé\U0001f600", min_size=1, max_size=9), min_size=1, max_size=12))
def test_trie_matches_scratch_segmentation(words):
    pieces = {"▁": -5, "▁a": -6, "a": -4, "ab": -7, "bc": -8, "c": -3, "abc": -10, "cab": -7, None: -20}
    trie = token_counts.Trie(pieces)
    for w in sorted(set(words)):
        assert trie.insert(w.encode()) == -brute(w, pieces)[1]


@pytest.mark.parametrize("nodes", [50, 400_000])
def test_documents(spark, sf_dir, monkeypatch, nodes):
    monkeypatch.setattr(token_counts, "MAX_NODES", nodes)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60 if nodes == 50 else 10**6)
    known = {}
    want = {}
    for r in docs.collect():
        words = r.text.encode().split()
        for w in set(words) - set(known):
            known[w] = -brute(w.decode(), PIECES)[1]
        want[r.doc_id] = (len(words), sum(known[w] for w in words))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.count_tokens(docs, PATH).collect()} == want


def test_scores_agree_with_a_unigram_model_of_the_library():
    vocab = [("<unk>", -1e9)] + [(p, s / 1e6) for p, s in PIECES.items() if p is not None]
    tokenizer = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False))
    for word in ["international", "xylophones", "thereof", "queaux", "uneinnützig", "a", "aaaaaaa"]:
        tokens = tokenizer.encode(token_counts.MARK + word).tokens
        score, count = brute(word, PIECES)
        assert sum(PIECES[t] for t in tokens) == pytest.approx(score, abs=5) and len(tokens) == -count


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a\x1cb \U0001f600"), (4, "a\x1cb \U0001f600"), (None, "x"), (5, "long " * 250_000)]
    docs = spark.createDataFrame([(i, t, 7, "q") for i, t in rows], "doc_id long, text string, n_words int, c string")
    found = sorted(map(tuple, token_counts.count_tokens(docs, PATH).collect()), key=str)
    want = [(i, len(w := (t or "").encode().split()), sum(-brute(x.decode(), PIECES)[1] for x in w[:1]) * len(w) if i == 5 else sum(-brute(x.decode(), PIECES)[1] for x in w)) for i, t in rows]
    assert found == sorted(want, key=str)
    assert token_counts.count_tokens(docs.limit(0), PATH).collect() == []
