import glob
import os
import random
from collections import defaultdict

import duckdb

from barloom.llm import queries, url_filters

RULES = queries._RULES
PAGES = "page_id long, url string, html string"


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    stop = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[stop:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
    return host, path


def rule_of(host, path, rules=RULES):
    fit = [(len(h + p), len(h), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, None)


def node(url):
    if not url or "://" not in url:
        return None
    host, path = parts(url)
    rest = url.split("://", 1)[1].split("#")[0]
    query = "?" + rest.split("?", 1)[1] if "?" in rest else ""
    for port in (":80", ":443"):
        host = host.removesuffix(port)
    return host + (path or "/") + query


def brute(rows, links):
    """Components by flooding; ``links``: pairs of URLs."""
    near = defaultdict(set)
    for a, b in links:
        if node(a) and node(b):
            near[node(a)].add(node(b))
            near[node(b)].add(node(a))
    out = []
    for page_id, url, _ in rows:
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        if verdict is None:
            seen, todo = {node(url)}, [node(url)]
            while todo:
                for x in near[todo.pop()] - seen:
                    seen.add(x)
                    todo.append(x)
            said = {rule_of(*parts("x://" + n))[1] for n in seen if n} if len(seen) > 1 else set()
            verdict = "allow" if "allow" in said else "block" if "block" in said else "allow"
        out.append((page_id, host, path, rule, verdict))
    return sorted(out, key=str)


def got(spark, rows, redirects=None, rules=RULES):
    pages = spark.createDataFrame([(*r, 1, "v") for r in rows], PAGES + ", node int, verdict string")
    rules = spark.createDataFrame(rules, "verdict string, host string, path string")
    table = None if redirects is None else spark.createDataFrame(redirects, "from_url string, to_url string")
    df = url_filters.judge(pages, rules, redirects=table)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rules_and_parts(spark):
    urls = [
        None, "", "no scheme/en/", "http://example.com", "http://example.com/", "HTTP://WWW.Example.COM/en/x?y#z", "https://a.b.example.com/en/", "https://myexample.com/en/1",
        "http://x.net/es/1", "http://x.net/fr", "http://net/fr/", "http://x.org/en/", "http://sub.www.example.com/en/1", "ftp://example.com?en/", "http://user@example.com:80/en/", "http://É.example.com/en/a\nb",
        "://", "http://", "http:///path", "a://b://c.net/es/",
    ]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(3, "http://x.net/es/1", None), (None, "http://x.net/es/1", "<p>")]
    assert got(spark, rows) == brute(rows, [])
    assert got(spark, []) == []


def test_longest_rule_then_longest_host_then_allow(spark):
    rules = [("block", "b.com", "/aa"), ("allow", "a.b.com", "/"), ("block", "a.b.com", "/"), ("block", "com", "/aaaa")]
    rows = [(1, "http://a.b.com/aaaa", None), (2, "http://a.b.com/x", None), (3, "http://b.com/aax", None), (4, "http://c.com/aaaa", None), (5, "http://c.com/a", None)]
    want = sorted(((i, *parts(u), *(lambda r: (r[0], r[1] or "allow"))(rule_of(*parts(u), rules))) for i, u, _ in rows), key=str)
    assert got(spark, rows, rules=rules) == want


def canonical(url):
    return f'<html><head><link  HREF="{url}" rel=\'canonical\'></head>'


LINKED = [
    (1, "http://a.org/en/1", canonical("http://spam.example.com/en/9")),  # a blocked URL that is not crawled
    (2, "http://a.org/en/2", '<meta http-equiv="Refresh" content="0; url=http://a.org/en/1">'),
    (3, "https://A.org:443/en/2#top", None),  # the same resource as 2
    (4, "http://b.org/x/y?q=1", '<link rel=canonical href=z>'),
    (5, "http://b.org/x/z", '<link rel="canonical" href="//c.net/es/1?a=1&amp;b=2">'),
    (6, "http://c.org/1", canonical("http://b.org/x/y?q=1") + canonical("http://ok.com/")),  # an allowed alias beside blocked ones
    (7, "http://d.org/1", "<!-- " + canonical("http://x.net/es/1") + " --><script>var x = '<link rel=canonical href=http://x.net/es/1>';</script>"),
    (8, "http://e.org/1", '<link rel="stylesheet" href="http://x.net/es/1"><link rel="alternate canonical2" href="http://x.net/es/1"><a rel="canonical" href="http://x.net/es/1">'),
    (9, "http://f.net/es/1", canonical("http://ok.com/")),  # its own rule
    (10, "http://g.org", canonical("mailto:x@x.net")), (11, "http://g.org/", canonical("?p=http://x.net/fr/")), (12, "no host", canonical("http://x.net/es/1")),
    (13, "http://h.org/a/b", canonical("../../x")), (14, "http://i.org/1", canonical("")), (15, "http://k.org/1", '<meta http-equiv=refresh content="30">'),
]
LINKS = [
    ("http://a.org/en/1", "http://spam.example.com/en/9"), ("http://a.org/en/2", "http://a.org/en/1"), ("http://b.org/x/y?q=1", "http://b.org/x/z"), ("http://b.org/x/z", "http://c.net/es/1?a=1&b=2"),
    ("http://c.org/1", "http://b.org/x/y?q=1"), ("http://c.org/1", "http://ok.com/"), ("http://f.net/es/1", "http://ok.com/"), ("http://g.org/", "http://g.org/?p=http://x.net/fr/"), ("http://h.org/a/b", "http://h.org/a/../../x"),
]


def test_aliases(spark):
    want = brute(LINKED, LINKS)
    assert got(spark, LINKED) == want
    verdicts = {r[0]: r[4] for r in want}
    assert [verdicts[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == ["block", "block", "block", "allow", "allow", "allow", "allow", "allow", "block"]


def test_redirects_of_a_table_long_chains_and_hubs(spark):
    rng = random.Random(3)
    rows = [(i, f"http://h{i}.org/{i}", None) for i in range(400)]
    chain = [(f"http://h{i}.org/{i}", f"http://h{i + 1}.org/{i + 1}") for i in range(0, 60)] + [("http://h60.org/60", "http://bad.net/fr/1")]
    hub = [(f"http://h{i}.org/{i}", "http://hub.org/") for i in range(100, 250)] + [("http://hub.org/", "http://bad.net/es/")]
    loose = [(f"http://h{rng.randint(250, 399)}.org/{0}", f"http://h{rng.randint(250, 399)}.org/{1}") for _ in range(50)]
    links = chain + hub + loose + [(None, "http://bad.net/es/"), ("http://h399.org/399", None), ("http://h398.org/398", "http://h398.org/398")]
    want = brute(rows, links)
    assert got(spark, rows, links) == want
    assert sum(r[4] == "block" for r in want) == 61 + 150


def test_the_query_sql_knows_aliases_too(spark, tmp_path):
    spark.createDataFrame(LINKED, PAGES).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{glob.glob(os.path.join(tmp_path, 'pages.parquet', '*.parquet'))[0]}'")
    df = queries.op12_url_filters(spark, str(tmp_path))
    assert sorted(map(tuple, df.collect())) == sorted(con.sql(queries.ORACLE_SQL["op12_url_filters"]).fetchall())
