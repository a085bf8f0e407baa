import re
from itertools import combinations

import corpus_pipeline as pipeline
from barloom.llm import quality_rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def edge_docs(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "x " * 300, None, "a", 1), (None, " ".join(f"w{i}" for i in range(60)), "en", "b", 2)]
    rows += [(4, " ".join(f"v{i}" for i in range(80)), "en", "b", 3)] * 2 + [(5, " ".join(f"v{i}" for i in range(80)), "en", "c", 3)]
    rows += [(6, " ".join(f"long{i}" for i in range(60_000)), "en", "c", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_keep_columns_and_survive_odd_rows(spark, sf_dir):
    docs = edge_docs(spark)
    for start in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES:
            out = stage(spark, start, sf_dir)
            rows = out.collect()
            if name != "token_files":
                assert out.columns == docs.columns
                assert [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
            assert start is docs or rows == []
    kept = sorted((str(r.doc_id) for r in pipeline.near_duplicates(spark, docs, sf_dir).collect()))
    assert kept == sorted(["1", "3", "None", "4", "6"])
    assert sorted(str(r.doc_id) for r in pipeline.quality(spark, docs, sf_dir).collect()) == sorted(["4", "4", "5", "6", "None"])


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    group = {r.doc_id: r.component for r in simhash.similar_documents(docs).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    near = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    exact = [(a, b) for a, b in near if texts[a] == texts[b]]
    assert exact and all(group[a] == group[b] for a, b in exact)
    other = [p for p in near if texts[p[0]] != texts[p[1]]]
    assert sum(group[a] == group[b] for a, b in other) >= 0.7 * len(other)
    # Whatever is grouped shares shingles with a member of its group.
    members = {}
    for i, g in group.items():
        members.setdefault(g, []).append(i)
    for ids in members.values():
        for i in ids if len(ids) > 1 else ():
            assert max(len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for j in ids if j != i) >= 0.3
    kept = {r.doc_id for r in pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == {min(ids) for ids in members.values()}


def test_decisions_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = {r.id: r for r in quality_rules.apply_rules(docs).drop("row").collect()}
    assert {r.doc_id: r.text for r in pipeline.quality(spark, docs, sf_dir).collect()} == {i: r.clean_text for i, r in judged.items() if r.kept}
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    letters = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: letters.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    windows = {tuple(w[i : i + 10]) for w in map(low, bench) for i in range(len(w) - 9)}
    texts = {r.doc_id: r.text for r in docs.collect()}
    clean = {r.doc_id: r.text for r in pipeline.decontaminated(spark, docs, sf_dir).collect()}
    for i, text in texts.items():
        w, hit = low(text), set()
        for p in range(len(w) - 9):
            if tuple(w[p : p + 10]) in windows:
                hit |= set(range(p, p + 10))
        if len(hit) > 0.5 * len(w):
            assert i not in clean
        else:
            assert low(clean[i]) == [x for p, x in enumerate(w) if p not in hit]
            assert hit or clean[i] == text


def test_run_numbers_all_tokens(spark, sf_dir):
    rows = sorted((r.start, r.n_tokens) for r in pipeline.run(spark, sf_dir).collect())
    at = 0
    for start, n in rows:
        assert start == at
        at += n


def _components(ids, pairs):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def _groups(labels):
    out = {}
    for i, label in labels.items():
        out.setdefault(label, set()).add(i)
    return sorted(map(sorted, out.values()))


def test_groups_are_the_components_of_all_pairs_at_the_similarity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    near = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = {r.doc_id: r.component for r in simhash.similar_documents(docs).collect()}
    assert all(group[a] == group[b] for a, b in near)
    assert _groups(group) == _groups(_components(sets, near))


def test_a_chain_of_near_copies_and_texts_just_below_the_similarity(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # each differs from the last in one word more; the ends are far apart
        base[(i * 37) % 200] = f"new{i}"
        rows.append((i, " ".join(base)))
    # 104 words are 100 shingles; cut to 84 words, 80 of them remain: exactly 0.8, and one word less is below.
    rows += [(100 + n, " ".join(f"v{i}" for i in range(n))) for n in (104, 84)]
    rows += [(300 + n, " ".join(f"u{i}" for i in range(n))) for n in (104, 83)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc_id: r.component for r in simhash.similar_documents(docs).collect()}
    sets = {i: shingles(t) for i, t in rows}
    near = [(a, b) for a, b in combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert (204, 184) in near and (404, 383) not in near
    assert _groups(group) == _groups(_components(sets, near))


def test_close_fingerprints_come_from_the_byte_position_index(spark, monkeypatch):
    base = [f"w{i}" for i in range(2000)]
    texts = [" ".join(base), " ".join([*base[:1999], "end"]), " ".join([*base, "more"]), " ".join(f"v{i}" for i in range(300)), " ".join(f"v{i}" for i in range(299)), "a b", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {simhash._set_key(x): x for x in (simhash.shingle_set(t and t.encode(), 5) for t in texts)}
    fps = {node: simhash._set_fingerprint(x) for node, x in sets.items()}
    close = {(a, b) for a, b in combinations(sorted(sets), 2) if ((fps[a] ^ fps[b]) & (1 << 64) - 1).bit_count() <= 3}
    assert len(close) >= 2
    seen, indexed = [], simhash.indexed_pairs

    def noted(nodes, *rest):
        out = indexed(nodes, *rest)
        seen.append({(r.a, r.b) for r in out.collect()})
        return out

    monkeypatch.setattr(simhash, "indexed_pairs", noted)
    group = {r.doc_id: r.component for r in simhash.similar_documents(docs).collect()}
    assert seen == [close]
    assert _groups(group) == [[0, 1, 2], [3, 4], [5], [6]]
