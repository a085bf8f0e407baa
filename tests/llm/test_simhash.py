from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import simhash

SCHEMA = "doc_id long, text string, fp string, node long, root string"


def brute(rows, size, distance):
    prints = {}
    for i, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if not words:
            prints.setdefault(0, []).append(i)
            continue
        grams = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        prints.setdefault(fp, []).append(i)
    root = {fp: fp for fp in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    least = {}
    for fp, ids in prints.items():
        for i in ids:
            if i is not None:
                least[find(fp)] = min(least.get(find(fp), i), i)
    return sorted(((i, f"{fp:016x}", least.get(find(fp))) for fp, ids in prints.items() for i in ids), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_matches_brute_force_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs, shingle_words=3)) == brute(rows, 3, 3)


def test_edge_rows(spark):
    long_text = " ".join(f"w{i % 977}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (4, "one"), (5, "a b c"), (None, "a b c"), (6, long_text), (7, long_text + " x"), (8, "É   b")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    assert got(simhash.near_duplicates(docs, shingle_words=3)) == brute(rows, 3, 3)
    assert got(simhash.near_duplicates(docs.limit(0))) == []


@pytest.mark.parametrize("limit", [512, 8, 2])
def test_long_posting_lists_lose_no_link(spark, limit):
    """A crowd of fingerprints within a few bytes, refined and linked densely or paired outright."""
    rng = np.random.default_rng(limit)
    base = int(rng.integers(1 << 62))
    crowd = {base ^ (int(x) << 16) ^ (int(y) << 24) for x, y in rng.integers(0, 256, (60, 2))}
    chain = {base ^ (1 << 40) ^ ((1 << (3 * k)) - 1) for k in range(13)}
    far = {int(x) for x in rng.integers(0, 1 << 62, 50)}
    fps = sorted(crowd | chain | far)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    rows = simhash.components(simhash.links(df, 3, limit)).collect()
    mine = {}
    for node, root in rows:
        mine.setdefault(root, set()).add(node)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            root[find(a)] = find(b)
    want = {}
    for f in fps:
        want.setdefault(find(f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 50)]
    edges = spark.createDataFrame(path + star, "a long, b long")
    found = simhash.components(edges).groupBy("root").agg(F.count("*").alias("n")).collect()
    assert sorted(r.n for r in found) == [49, 61]
