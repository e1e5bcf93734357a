"""Allow and block rules for urls, with decisions carried over to aliases.

Pages that redirect to each other, or name each other as canonical, are one
component of a graph of urls.  What a rule blocks, it blocks for all aliases that
no rule allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeledger.llm.components import components
from codeledger.session import checkpointed

#: (verdict, host, path): the rule fits the host and its subdomains, and paths that start so.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


def judge_urls(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, component) for every page.

    The longest rule that fits a url decides; of equally long ones, the first of
    ``rules``.  A url without a rule is blocked when one of its aliases is blocked by a
    rule and none is allowed by one; otherwise it is allowed.  Aliases are the urls
    joined by redirects (``meta`` refresh) and canonical links in any number of steps;
    targets need not be pages themselves.  component is the least
    alias, null for a url without edges.

    Urls are compared by host, path and query.  A null url, or one without
    ``://``, has an empty host and path, no rule, no alias, and is allowed.
    Repeated rows each give a row.  Other columns are not read.  Empty table: no rows.
    """
    urls = pages.select("page_id", "url")
    urls = _judged(urls, "url", rules).withColumn("key", _key("url"))
    edges = checkpointed(alias_edges(pages))
    # copies and hubs meet as one row each; only urls with an edge are in the graph
    nodes = edges.select(F.col("a").alias("key")).union(edges.select(F.col("b").alias("key"))).distinct()
    ruled = _judged(nodes.withColumn("full", F.concat(F.lit("x://"), F.col("key"))), "full", rules)
    groups = components(edges)
    aliases = ruled.join(groups, ruled["key"] == groups["node"], "left").withColumn("component", F.coalesce("component", "key"))
    found = aliases.groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("own") == "block"), F.lit(False)).alias("blocked"),
        F.coalesce(F.bool_or(F.col("own") == "allow"), F.lit(False)).alias("allowed"),
    )
    shared = aliases.select("key", "component").join(found, "component")
    rows = urls.join(shared, "key", "left")
    passed_on = F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("own", passed_on).alias("verdict"), "component")


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): keys of a page's url and of each redirect or canonical target in its html."""
    marked = pages.select("url", "html").where(F.col("html").rlike("(?i)canonical|refresh"))
    links = F.transform(F.regexp_extract_all("html", F.lit(CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1))
    jumps = F.transform(F.regexp_extract_all("html", F.lit(REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, TARGET, 1))
    targets = marked.select("url", F.explode(F.concat(links, jumps)).alias("target")).where("target <> ''")
    edges = targets.select(_key("url").alias("a"), _key(_resolved("url", "target")).alias("b"))
    return edges.where("a is not null and b is not null and a <> b").distinct()


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _host(url: str | Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def _path(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def _key(url: str | Column) -> Column:
    """Host, path and query; null without a host."""
    path = _path(url)
    key = F.concat(_host(url), F.when(path == "", "/").otherwise(path), F.regexp_extract(url, PARTS, 3))
    return F.when(_host(url) != "", key)


def _resolved(url: str, target: str) -> Column:
    """``target`` as an absolute url, read from ``url``."""
    base = F.concat(F.lit("x://"), _host(url))
    folder = F.regexp_replace(_path(url), "[^/]*$", "")
    return (
        F.when(F.col(target).rlike("(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), F.col(target))
        .when(F.startswith(F.col(target), F.lit("//")), F.concat(F.lit("x:"), F.col(target)))
        .when(F.startswith(F.col(target), F.lit("/")), F.concat(base, F.col(target)))
        .when(F.startswith(F.col(target), F.lit("?")), F.concat(base, _path(url), F.col(target)))
        .when(F.startswith(F.col(target), F.lit("#")), F.col(url))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), F.col(target)))
    )


def _judged(rows: DataFrame, url: str, rules: tuple) -> DataFrame:
    """``rows`` with host, path, the text of the rule that decides, and its verdict (own)."""
    rows = rows.withColumn("host", _host(url)).withColumn("path", _path(url))
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    rule, own = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, host, path in reversed(ordered):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
        rule = F.when(fits, host + path).otherwise(rule)
        own = F.when(fits, verdict).otherwise(own)
    return rows.withColumn("rule", rule).withColumn("own", own)
