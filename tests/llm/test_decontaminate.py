import random
import re

import pytest

from barloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[p : p + n]), set()).add("" if i is None else str(i))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for p in range(len(w) - n + 1):
                if (x := tuple(w[p : p + n])) in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[x]
        out.append((i, len(w), len(hit), sorted(found), sorted(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(
        ((r.row.doc_id, r.n_words, r.n_hit, list(r["items"]), [k for s in r.spans for k in range(s.first, s.end)]) for r in df.collect()), key=str
    )


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, [2], "z") for i, t in docs], "doc_id long, text string, len int, spans array<int>, k1 string"),
        spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, win string"),
    )


@pytest.mark.parametrize("chunk", [7, 2048])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(decontaminate, "CHUNK_WORDS", chunk)
    rng = random.Random(5)
    base = [rng.choice(["aa", "b", "C", "dé", "7"]) + str(rng.randrange(3)) for _ in range(300)]
    items = [(1, " ".join(base[10:40])), (2, " ".join(base[30:45])), (2, " ".join(base[100:112])), (None, ", ".join(base[200:206])), (9, "lone"), (10, None), (11, "!!"), (12, " ".join(base[10:40]))]
    docs = [(i, " ".join(base[rng.randrange(200) :][: rng.randrange(1, 90)])) for i in range(25)]
    docs += [(50, None), (51, ""), (52, "  -- !"), (53, " ".join(base)), (53, " ".join(base)), (None, "x LONE y"), (54, "-".join(base[25:60]).upper()), (55, " ".join(base[30:39]))]
    docs.append((56, "pad " * 50_000 + " ".join(base[10:25])))
    d, b = frames(spark, docs, items)
    assert got(decontaminate.contamination(d, b)) == brute(docs, items)
    assert got(decontaminate.contamination(d.limit(0), b)) == []
    assert got(decontaminate.contamination(d, b.limit(0))) == brute(docs, [])


def test_shuffled_join_agrees(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, [tuple(r) for r in items.collect()])
    assert any(r[2] for r in want)
    assert got(decontaminate.contamination(docs, items)) == want
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(decontaminate, "BROADCAST_HITS", 0)
    assert got(decontaminate.contamination(docs, items)) == want
    monkeypatch.setattr(decontaminate, "HOT_COPIES", 0)
    monkeypatch.setattr(decontaminate, "HOT_TEXTS", 3)
    assert got(decontaminate.contamination(docs.unionByName(docs), items)) == sorted(want * 2, key=str)


def test_winnowing_thins_what_is_joined(spark, sf_dir):
    """Rows that a shuffled join would move: runs of equal minima, not word positions, and numbers only."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chunks = decontaminate._chunks(docs.select("doc_id", decontaminate.words_of(decontaminate.lower_ascii(docs.text)).alias("all_words")), ["doc_id"], 10)
    runs = decontaminate._fingerprint_runs(chunks, 10, 5, []).drop("words")
    windows = sum(max(0, len(words(r.text)) - 9) for r in docs.collect())
    held = runs.selectExpr("count(*) n", "sum(end - first) w").first()
    assert held.w >= windows and held.n < 0.4 * windows
    assert set(dict(runs.dtypes).values()) == {"bigint", "int"}


@pytest.mark.parametrize("text", ["", "one", "  Ab, c-d  e\n\nf. ", "a b c d e f", "é1 2--3 "])
def test_without_spans(spark, text):
    n = len(words(text))
    cases = [[], [(0, n)], [(a, a + 1) for a in range(0, n, 2)]] + [[(1, 3), (4, 5)]] * (n >= 5)
    for spans in cases:
        df = spark.createDataFrame([(text, spans)], "text string, spans array<struct<first:int,end:int>>")
        out = df.select(decontaminate.without_spans(df.text, df.spans).alias("t")).first().t
        gone = {i for a, b in spans for i in range(a, b)}
        assert words(out) == [w for i, w in enumerate(words(text)) if i not in gone]
        if not spans:
            assert out == text
