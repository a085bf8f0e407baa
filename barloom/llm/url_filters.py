"""URL filters: rules by host and path, and redirect equivalence.

A rule fits its host and all subdomains where the path starts with the rule's;
the longest one decides.  Rules meet the distinct hosts once, through the
suffixes of each host, so the list of rules may be of any size and a host with
a third of all pages costs one row.

Pages without a rule of their own are judged with their aliases: URLs that
redirects or canonical links connect, found as connected components of the
links.  An alias that is explicitly allowed takes precedence over blocked ones;
without either a page is allowed.  Links, nodes and components stay
distributed, and only pages without a rule take part in that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm._spark import lower_ascii, stored
from barloom.llm.simhash import components

#: ``scheme://``, then the host up to ``/``, ``?``, ``#``, then the path up to ``?`` or ``#``.
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
#: An attribute's value in double, single or no quotes.
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def url_parts(url: Column) -> tuple[Column, Column]:
    """``host`` (A-Z lower-cased) and ``path``; both empty for null and for what has no ``://``."""
    known = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(known, _URL, 1)), F.regexp_extract(known, _URL, 2)


def url_node(url: Column) -> Column:
    """What two spellings of one resource share: host, path and query, without scheme, default port and fragment; null without ``://``."""
    host, path = url_parts(url)
    host = F.regexp_replace(host, ":(80|443)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 3)
    return F.when(F.contains(url, F.lit("://")), F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def _value(tag: Column, attribute: str) -> Column:
    """An attribute's value, empty without one."""
    found = rf"(?is)[\s\"']{attribute}{_VALUE}"
    return F.concat(*[F.regexp_extract(tag, found, i) for i in (1, 2, 3)])


def link_targets(html: Column) -> Column:
    """Targets of the canonical links and of the ``refresh`` redirects of a page, as written there.

    Comments, scripts and styles are not read.
    """
    tags = F.regexp_extract_all(F.regexp_replace(html, _UNSEEN, ""), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)

    def target(tag: Column) -> Column:
        canonical = F.lower(tag).startswith("<link") & _value(tag, "rel").rlike(r"(?i)(^|\s)canonical($|\s)")
        refresh = F.lower(tag).startswith("<meta") & (F.lower(F.trim(_value(tag, "http-equiv"))) == "refresh")
        goal = F.regexp_extract(_value(tag, "content"), r"""(?is)^[\s\d.]*[;,]?\s*url\s*=\s*["']?([^"']*)""", 1)
        return F.trim(F.replace(F.when(canonical, _value(tag, "href")).when(refresh, goal), F.lit("&amp;"), F.lit("&")))

    return F.filter(F.transform(tags, target), lambda t: t.isNotNull() & (t != ""))


def resolved(target: Column, url: Column) -> Column:
    """A target as an absolute URL; null where it names none (other schemes, pages without ``://``)."""
    host, path = url_parts(url)
    site = F.concat(F.lit("http://"), host)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:") | (host == ""), F.lit(None))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?") | target.startswith("#"), F.concat(site, path, target))
        .otherwise(F.concat(site, F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", "")), target))
    )


def alias_links(pages: DataFrame, url_col: str, html_col: str, redirects: DataFrame | None) -> DataFrame:
    """Distinct ``(from_node, to_node)``: from pages to their canonical and refresh targets, and the redirects ``(from_url, to_url)``."""
    html = F.col(html_col).cast("string")
    linking = pages.where(html.rlike(r"(?i)canonical|http-equiv")).select(F.col(url_col).alias("url"), F.explode(link_targets(html)).alias("target"))
    found = linking.select(url_node(F.col("url")).alias("from_node"), url_node(resolved(F.col("target"), F.col("url"))).alias("to_node"))
    if redirects is not None:
        found = found.unionByName(redirects.select(url_node(F.col("from_url")).alias("from_node"), url_node(F.col("to_url")).alias("to_node")))
    return found.where("from_node <> to_node").distinct()


def _suffixes(host: Column) -> Column:
    """A host and the domains above it: ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host`` and ``path``) and the ``rule`` that decides them, a struct ``(text, verdict)`` or null.

    ``rules``: ``verdict, host, path``.  The longest host and path wins, then
    the longest host, then an allowing rule.
    """
    clean = rules.select(lower_ascii(F.col("host")).alias("suffix"), F.col("path").alias("rule_path"), "verdict").distinct()
    hosts = urls.select("host").where("host <> ''").distinct().select("host", F.explode(_suffixes(F.col("host"))).alias("suffix"))
    text = F.concat("suffix", "rule_path")
    entry = F.struct(F.length(text).alias("size"), F.length("suffix").alias("host_size"), (F.col("verdict") == "allow").alias("allows"), "rule_path", text.alias("text"), "verdict")
    # Written: behind an aggregate Spark does not split a hot host's side of the join.
    of_host = stored(hosts.join(clean, "suffix").groupBy("host").agg(F.collect_list(entry).alias("entries")), "host-rules")
    fitting = F.filter("entries", lambda e: F.col("path").startswith(e["rule_path"]))
    best = F.array_max(fitting)
    return urls.join(of_host, "host", "left").withColumn("rule", F.when(best.isNotNull(), F.struct(best["text"].alias("text"), best["verdict"].alias("verdict")))).drop("entries")


def alias_verdicts(links: DataFrame, rules: DataFrame) -> DataFrame:
    """``(node, alias_verdict)`` of the nodes whose component holds an explicitly judged one.

    Every URL of a link is judged by the rules, crawled or not.
    """
    key = lambda c: F.unhex(F.md5(F.col(c)))
    found = components(links.select(key("from_node").alias("a"), key("to_node").alias("b")))
    nodes = links.select(F.explode(F.array("from_node", "to_node")).alias("at")).distinct()
    judged = with_rules(nodes.select("at", F.regexp_extract("at", "^[^/]*", 0).alias("host"), F.regexp_extract("at", r"(?s)^[^/]*([^?]*)", 1).alias("path")), rules)
    placed = judged.select("at", key("at").alias("node"), F.col("rule.verdict").alias("verdict")).join(found, "node")
    explicit = placed.groupBy("root").agg(F.min("verdict").alias("alias_verdict")).where("alias_verdict IS NOT NULL")  # allow before block
    return placed.join(explicit, "root").select(F.col("at").alias("node"), "alias_verdict")


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None
) -> DataFrame:
    """One row per input row: ``id_col, host, path, rule, verdict`` (allow or block).

    A page's own rule decides; else an explicitly allowed alias, else a blocked
    one; else it is allowed.  A null URL, or one without ``://``, has an empty
    host and path, no rule and no alias, and is allowed; null pages have no
    links.  Rows with equal URLs get equal results, null ids stay; an empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), url_node(F.col(url_col)).alias("node"))
    judged = with_rules(rows, rules)
    links = stored(alias_links(pages, url_col, html_col, redirects), "alias-links")
    aliases = alias_verdicts(links, rules)
    # Pages with a rule, or without a node, are no part of the join.
    open_ones = judged.where("rule IS NULL AND node IS NOT NULL").join(aliases, "node", "left").withColumn("verdict", F.coalesce("alias_verdict", F.lit("allow")))
    settled = judged.where("rule IS NOT NULL OR node IS NULL").withColumn("verdict", F.coalesce("rule.verdict", F.lit("allow")))
    columns = [F.col("id").alias(id_col), F.col("host"), F.col("path"), F.col("rule.text").alias("rule"), F.col("verdict")]
    return settled.select(*columns).unionByName(open_ones.select(*columns))
