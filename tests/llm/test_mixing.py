import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from barloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    left, total, target, free = 0, sum(sizes.values()), {s: Fraction(0) for s in names}, set(names)
    left = Fraction(total)
    while left > 0 and free:  # reshare the excess until none is above
        w = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / w
        left = Fraction(0)
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = Fraction(3 * sizes[s])
                free.discard(s)
    return target


def check(rows, found):
    """rows: (doc_id, text, source); found: (doc_id, size, source_size, target, taken)."""
    sizes, by_id = defaultdict(int), {}
    for i, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    taken = defaultdict(int)
    order = defaultdict(list)
    assert len(found) == len(rows)
    for (i, text, source), got in zip(sorted(rows, key=str), sorted(found, key=str), strict=True):
        assert got[0] == i and got[1] == len(WORD.findall(text or "")) and got[2] == sizes[source]
        assert got[3] == pytest.approx(float(want[source]))
        assert 0 <= got[4] <= 3 * got[1]
        taken[source] += got[4]
        order[source].append((hashlib.md5(f"1:{i}".encode()).hexdigest(), got[1], got[4]))
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= 0.51
        assert sum(1 for _, n, t in order[s] if n and t % n) <= 1  # one document is cut at most
        whole = [t // n for _, n, t in sorted(order[s]) if n]
        assert whole == sorted(whole, reverse=True)


def collected(df):
    return [(r["row"]["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in df.collect()]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, collected(mixing.mix(docs)))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 3, "k") for i, t, s in rows], "doc_id long, text string, source string, size int, key string")


@pytest.mark.parametrize("lengths", [(1000, 10, 10, 10), (5, 5, 5, 5), (0, 3, 100, 1), (1, 1, 1, 300)])
def test_skewed_sources_and_edges(spark, lengths):
    rows, i = [], 0
    for k, n in enumerate(lengths):
        for _ in range(n):
            rows.append((i, "w " * (1 + i % 7), [None, "b", "a", "\U0001f600"][k]))
            i += 1
    rows += [(9000, None, "a"), (9001, "", "empty"), (9002, "x\x1cy\x0bz", "b")]
    df = frame(spark, rows)
    found = collected(mixing.mix(df))
    check(rows, found)
    assert sorted(found, key=str) == sorted(collected(mixing.mix(df.repartition(5))), key=str)


def test_repeated_rows_and_empty(spark):
    rows = [(1, "a b c", "s")] * 4 + [(None, "d e", "t")] * 2
    found = collected(mixing.mix(frame(spark, rows)))
    assert len(found) == 6 and sum(f[4] for f in found) == 16
    assert collected(mixing.mix(frame(spark, rows).limit(0))) == []


def test_mixed_documents_hold_the_taken_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    taken = {r[0]: r[4] for r in collected(mixing.mix(docs))}
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        assert texts[r.doc_id].lstrip().startswith(r.text.strip()) or texts[r.doc_id] == r.text
        words[r.doc_id] += len(WORD.findall(r.text))
    assert dict(words) == {i: n for i, n in taken.items() if n}
