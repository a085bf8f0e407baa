import zlib

import numpy as np
import pytest

from barloom.llm import quality_model as qm


def brute(text, slope, bias):
    """Features one by one, with hashing of single words."""
    words = (text or "").encode().split()
    total, n, keys = 0.0, 0, []
    for w in words:
        buckets, sizes, key = qm.word_features([w])
        keys.append(key[0])
        assert sizes.tolist() == [len(buckets)]
        c = len(w.decode()) + 2
        assert len(buckets) == 1 + sum(max(0, c - g + 1) for g in qm.GRAMS)
        total, n = total + slope[buckets].sum(), n + len(buckets)
    for pair in zip(keys, keys[1:]):
        total, n = total + qm.PAIR_WEIGHT * slope[qm.pair_features(np.array(pair))].sum(), n + qm.PAIR_WEIGHT
    return 1 / (1 + np.exp(-(bias + total / max(n, 1))))


def test_features_of_many_words_are_those_of_each():
    words = [b"a", "é\U0001f600ß".encode(), b"<x>", b"<", b"longer-word", b"a"]
    buckets, sizes, _ = qm.word_features(words)
    apart = [qm.word_features([w])[0] for w in words]
    assert [sorted(x) for x in np.split(buckets, np.cumsum(sizes)[:-1])] == [sorted(x) for x in apart]


@pytest.mark.parametrize("cache", [5, 400_000])
def test_scorer_matches_brute_force(monkeypatch, cache):
    monkeypatch.setattr(qm, "CACHE_WORDS", cache)
    monkeypatch.setattr(qm, "PART", 7 if cache == 5 else 100_000)
    slope, bias = np.random.default_rng(1).normal(size=qm.BUCKETS), 0.25
    texts = ["", "one two two", "\x1c é one", "b " * 1000, "the end of it all and more words than five"]
    assert qm.Scorer(slope, bias).score([t.encode() for t in texts]) == pytest.approx([brute(t, slope, bias) for t in texts])


def test_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = qm.fit(docs, labels)
    assert model == qm.fit(docs.repartition(5), labels.repartition(3))
    rows = {r.doc_id: r for r in qm.score(docs, model).collect()}
    values = np.frombuffer(model)
    for r in docs.collect():
        assert rows[r.doc_id].score == pytest.approx(brute(r.text, values[1:], values[0]))
        assert rows[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert rows[r.doc_id].predicted == int(rows[r.doc_id].score >= 0.3)
    judged = [(r.quality, rows[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert np.mean([a == r.predicted for a, r in judged]) >= 0.95


def test_held_out_ranking(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = qm.score(docs, qm.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    # The share of pairs in the right order: 0.99 and more with bigrams, 0.90 on words and their n-grams alone.
    assert np.mean(np.array(good)[:, None] > np.array(bad)) >= 0.98


def test_broken_utf8_has_a_score(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    assert [r.score for r in qm.score(docs, np.zeros(qm.BUCKETS + 1).tobytes()).collect()] == [0.5]


def test_held_out_labels_teach_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    assert qm.fit(docs, labels) == qm.fit(docs, other)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "w " * 300_000)]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, label string")
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    flat = qm.fit(docs, none)
    assert {r.score for r in qm.score(docs, flat).collect()} == {0.5}
    some = spark.createDataFrame([(3, 1, ""), (3, 0, ""), (2, None, ""), (None, 0, ""), (4, 0, ""), (1, 0, ""), (6, 0, "")], "doc_id long, quality int, text string")
    found = qm.score(docs, qm.fit(docs, some)).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert qm.score(docs.limit(0), flat).collect() == []
