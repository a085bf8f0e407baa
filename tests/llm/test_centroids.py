import hashlib
import math
import random

import numpy as np

from barloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=16, rounds=3, dims=64, scale=64):
    """Plain Python integers, all distances whole."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    key = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    means = [list(v) for _, v in sorted(kept, key=lambda r: (key(r[0]), r[1]))[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(means)), key=lambda j: (dist(v, means[j]), j))
    for _ in range(rounds):
        groups = [[] for _ in means]
        for _, v in kept:
            groups[nearest(v)].append(v)
        means = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else m for g, m in zip(groups, means, strict=True)]
    chosen = [(i, j := nearest(v), dist(v, means[j])) for i, v in kept]
    own = [sum(d for _, c, d in chosen if c == j) for j in range(len(means))]
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted(((i, j, d, own[j], sum(own), digest[j]) for i, j, d in chosen), key=str)


def single(x):
    return float(np.float32(x))


def got(spark, rows, **options):
    df = centroids.cluster(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA.replace("label", "cluster")), **options)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(rng, n, spread=1.0):
    hubs = [[rng.gauss(0, spread) for _ in range(64)] for _ in range(5)]
    return [(i, [single(h + rng.gauss(0, 0.2)) for h in rng.choice(hubs)]) for i in range(n)]


def test_against_plain_integers(spark):
    rows = vectors(random.Random(2), 300)
    assert got(spark, rows) == brute(rows)


def test_dropped_rows_ties_copies_and_few_vectors(spark):
    rng = random.Random(4)
    good = vectors(rng, 9)
    bad = [(20, None), (21, []), (22, [1.0] * 63), (23, [1.0] * 65), (24, [1.0] * 63 + [None]), (25, [float("nan")] + [0.0] * 63), (26, [float("-inf")] + [0.0] * 63)]
    rows = [*good, *bad, good[0], good[0], (None, good[1][1]), (None, [0.5] * 64)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, bad) == [] and got(spark, []) == []
    same = [(i, [0.25] * 64) for i in range(40)]  # every distance ties: all in cluster 0, the others stay empty
    assert got(spark, same) == brute(same) and {r[1] for r in got(spark, same)} == {0}


def test_half_way_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(x)] + [0.0] * 63) for i, x in enumerate([0, 2, 1, 1, 1, 4, 3, 3])]
    for rounds in (0, 1, 3):
        assert got(spark, rows, clusters=3, rounds=rounds) == brute(rows, k=3, rounds=rounds)


def test_abandoning_changes_nothing():
    rng = np.random.default_rng(7)
    for dims in (1, 7, 64):
        x, c = rng.integers(-50, 50, (200, dims)), rng.integers(-50, 50, (16, dims))
        want = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        chosen, best = centroids.nearest(x, c, rng.permutation(dims))
        assert (chosen == want.argmin(1)).all() and (best == want.min(1)).all()


def test_huge_components_are_clamped(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)]
    found = got(spark, rows, clusters=2, rounds=1)
    assert len(found) == 3 and all(0 <= r[2] <= centroids.LARGEST and r[3] <= r[4] <= centroids.LARGEST for r in found)
