import random
import re
from fractions import Fraction
from itertools import permutations

import pytest

from barloom.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(rows):
    """Letters that each row fails, one document at a time."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        same = [i for i, other, _ in rows if (other or "") == t and i is not None]
        out.append({
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": bool(same) and (doc_id is None or min(same) < doc_id),
        })
    return out


def brute(rows, labels):
    """Every order applied document by document."""
    fails = failing(rows)
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in (0, 1))
    out = []
    for part in {p or "" for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails, strict=True) if (p or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                failed = sum(f[letter] for _, f in own)
                alone = sum(f[letter] and sum(f.values()) == 1 for _, f in own)
                removed_by[letter] += len(gone)
                found.append([part, "".join(order), step, len(left), len(gone), failed - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), letter])
        out += [tuple([*r[:-1], removed_by[r[-1]]]) for r in found]
    return sorted(out)


def got(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, 7, "x") for i, t, p in rows], "doc_id long, text string, lang string, mask int, part string")
    df = filter_audit.audit(docs, spark.createDataFrame(labels, LABELS))
    assert df.columns == COLUMNS and dict(df.dtypes)["step"] == "int"
    return sorted(tuple(r) for r in df.collect())


def texts(rng, n):
    words = ["alpha", "beta", "gamma", "Delta", "ROOT", "é", "x#", "100%", "z"]
    return [" ".join(rng.choice(words[: rng.randint(2, 9)]) + (str(rng.random()) if rng.random() < 0.6 else "") for _ in range(rng.choice([3, 150, 250, 400]))) for _ in range(n)]


def test_against_every_order_applied_to_every_document(spark):
    rng = random.Random(5)
    pool = [*texts(rng, 40), None, ""]
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None, ""])) for i in range(150)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 150, 2)]
    assert got(spark, rows, labels) == brute(rows, labels)


def test_edge_rows(spark):
    long = "Word " * 200_000
    rows = [
        (1, "Same text", "en"), (1, "Same text", "en"), (2, "Same text", "de"), (None, "Same text", "en"), (None, "only null ids", "en"), (None, "only null ids", "en"),
        (3, None, None), (4, "", ""), (5, long, "en"), (6, long, "fr"), (7, "\x0b\x0c\r\n \t", "en"), (8, "ÀÉ  Ö", "en"), (9, "a\u00a0b", "en"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (None, 1, 1), (5, None, 1), (6, 1, None), (99, 1, 1)]
    assert got(spark, rows, labels) == brute(rows, labels)
    assert got(spark, [], labels) == []
    assert got(spark, rows, []) == brute(rows, [])


def test_the_first_copy_is_the_one_in_the_table_not_in_the_part(spark):
    rows = [(9, "t", "en"), (3, "t", "de"), (5, "t", "en")]
    first = {(r[0]): r[4] for r in got(spark, rows, []) if r[1][0] == "E" and r[2] == 1}
    assert first == {"en": 2, "de": 0}


def test_the_polynomial_is_the_mean_over_orders():
    rng = random.Random(1)
    for m in (1, 2, 3, 4, 5):
        counts = [rng.randint(0, 9) for _ in range(1 << m)]
        p = filter_audit.Removals(counts)
        removes = lambda s: sum(c for mask, c in enumerate(counts) if mask & s)  # noqa: B023, E731
        assert p.corners() == [removes(s) for s in range(1 << m)]
        for i in range(m):
            total, orders = 0, list(permutations(range(m)))
            for order in orders:
                before = sum(1 << j for j in order[: order.index(i)])
                total += removes(before | 1 << i) - removes(before)
            assert p.shapley(i) == Fraction(total, len(orders))


def test_too_many_filters_are_refused(spark):
    with pytest.raises(ValueError, match="orders"):
        filter_audit.interactions(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "ABCDEFG")
