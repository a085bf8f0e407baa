import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    first = {}
    rank = lambda i: (i is None, i or 0)
    for i, text in rows:
        w = WORD.findall(text or "")
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            first[key] = min(first.get(key, rank(i)), rank(i))
    out = []
    for i, text in rows:
        w, gone = WORD.findall(text or ""), set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] < rank(i):
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), min_size=3, max_size=14), min_size=1, max_size=6), st.integers(1, 4))
def test_automaton_finds_first_documents(texts, window):
    automaton = substrings.SuffixAutomaton()
    first = {}
    for doc, words in enumerate(texts):
        want = [first.get(tuple(words[p : p + window]), -1) for p in range(len(words) - window + 1)]
        assert automaton.matches(words, window) == want
        automaton.add(words, doc)
        for p in range(len(words) - window + 1):
            first.setdefault(tuple(words[p : p + window]), doc)


@pytest.mark.parametrize("units", [2000, 1])
def test_passages_copies_and_edges(spark, monkeypatch, units):
    monkeypatch.setattr(substrings, "MAX_UNITS", units)
    rng = random.Random(units)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 3)
    base = [word() for _ in range(120)]
    rows = [(i, " ".join([word() for _ in range(rng.randrange(12))] + base[(a := rng.randrange(100)) : a + rng.randrange(5, 60)] + [word() for _ in range(rng.randrange(12))])) for i in range(30)]
    rows += [(40 + i, "\n".join(base)) for i in range(3)] + [(5, " ".join(base[:40])), (None, " ".join(base)), (None, None), (60, ""), (61, " \t"), (62, "x " * 50)]
    rows += [(70, "é\x1cü " * 30), (71, "é\x1cü " * 31), (72, "é ü " * 30), (-3, " ".join(base[50:70]))]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, h int, marks string")
    assert got(substrings.remove_repeats(df)) == brute(rows, 13)
    assert got(substrings.remove_repeats(df.limit(0))) == []


def test_documents_and_a_very_long_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    long_text = " ".join(f"w{i * i % 10007}" for i in range(300_000))
    extra = spark.createDataFrame([(10**6, long_text), (10**6 + 1, "start " + long_text[: 2**21])], "doc_id long, text string")
    rows = [tuple(r) for r in docs.unionByName(extra).collect()]
    assert got(substrings.remove_repeats(docs.unionByName(extra))) == brute(rows, 13)


def test_word_hashes_do_not_depend_on_the_text():
    blob = b"x" * (substrings._PIECE // 2 + 5)
    alone = {w: int(substrings.word_hashes(w)[0]) for w in (b"a", "é".encode(), blob)}
    short, long = b"a " + blob + b" a", b"\xc3\xa9 a " * substrings._PIECE + blob + b" a"
    for text in (short, long):
        assert substrings.word_hashes(text).tolist() == [alone[w] for w in text.split()]
