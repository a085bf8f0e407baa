import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]", "0", line.lower())).strip(" ")


def brute(rows, min_docs, share, min_words=20):
    texts, where = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                where[host, normal(line)].add(text)
    common = {k for k, v in where.items() if len(v) > min_docs and len(v) > share * len(texts[k[0]])}
    out = []
    for i, text, host in rows:
        base = brute_base(text or "")
        lines = [x for x in (text or "").split("\n") if (host, normal(x)) not in common]
        left = len(WORD.findall("\n".join(lines)))
        failed = base[0] < min_words or 100 * base[4] > 30 * base[0]
        kept = not failed and 100 * left >= 50 * base[0] and left >= min_words
        out.append((i, *base, base[0] - left, None if text is None else "\n".join(lines), failed, kept))
    return sorted(out, key=str)


COLUMNS = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "clean_text", "base_failed", "kept"]


def got(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t# \x1cé", max_size=200))
def test_base_measures(text):
    assert quality_rules.base_measures(text) == brute_base(text)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert got(quality_rules.apply_rules(docs, min_docs=2, max_share=0.1)) == brute(rows, 2, 0.1)


def test_edge_rows(spark):
    own = lambda k: " ".join(f"own{k}w{j}" for j in range(25))
    foot = "Page 12   of the  FOOT " + " ".join(f"x{j}" for j in range(18))
    rows = [(k, f"{own(k)}\n{foot.replace('12', str(k + 10))}", "h") for k in range(5)]
    rows += [(10 + k, f"{own(99)}\n{foot}", "h") for k in range(4)]  # copies: one document
    rows += [(20, None, "h"), (21, "", None), (22, f"short\n{foot}", "h"), (23, "a " * 100_000, "h"), (None, own(7), None), (None, own(7), None)]
    rows += [(30, f"{own(30)}\n{foot}", None), (31, own(31) + "\n\r\n \n" + own(32), "j")]
    df = spark.createDataFrame([(i, t, h, 1, "y") for i, t, h in rows], "doc_id long, text string, source string, k1 int, host string")
    result = got(quality_rules.apply_rules(df, min_docs=3, max_share=0.01))
    assert result == brute(rows, 3, 0.01)
    assert any(r[0] == 22 and not r[-1] and not r[-2] for r in result)  # depleted, not failed
    assert got(quality_rules.apply_rules(df.limit(0))) == []
