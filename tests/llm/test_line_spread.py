import re
from collections import defaultdict

import pytest

from barloom.llm import line_spread

WORD = re.compile(r"[^\x20\x09-\x0D]")


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                sites[normal(line)].add((site is None, site))
    bad = {k for k, v in sites.items() if len(v) >= min_sites}
    out = []
    for i, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        left = [x for x in lines if not (WORD.search(x) and normal(x) in bad)]
        out.append((i, text, len(lines), len(lines) - len(left), None if text is None else "\n".join(left)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_removed", "clean_text").collect()), key=str)


@pytest.mark.parametrize("lg_k", [12, 4])
def test_near_and_far_from_the_limit(spark, monkeypatch, lg_k):
    monkeypatch.setattr(line_spread, "LG_K", lg_k)
    rows = [(s, "\n".join(f"Line {k}  of\tmany" for k in range(s % 40, 60)) + f"\nown {s}\n\n  ", f"site{s}") for s in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (1, 2, 40, 90, 120, 121):
        assert got(line_spread.remove_boilerplate(df, min_sites=limit)) == brute(rows, limit)


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "\n \n", "c"), (4, "X y\n\nZ", "a"), (5, "x  Y\r\nq", "b"), (5, "x  Y\r\nq", "b"), (None, "x y", None), (6, "x y\n" * 50_000, "d")]
    df = spark.createDataFrame([(i, t, s, 1, "v") for i, t, s in rows], "doc_id long, text string, source string, k1 int, line string")
    for limit in (2, 4, 9):
        assert got(line_spread.remove_boilerplate(df, min_sites=limit)) == brute(rows, limit)
    assert got(line_spread.remove_boilerplate(df.limit(0))) == []


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert got(line_spread.remove_boilerplate(docs, min_sites=2)) == brute(rows, 2)
