"""URL filters with redirect equivalence, in DataFrame operations only.

Urls that redirect to each other, or name each other as canonical, are aliases. Rules decide urls
directly; decisions then spread over the connected components of the alias graph: a url without a rule
of its own is blocked if an alias is, unless an alias is explicitly allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyloom.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z lower-cased; null or no ://: empty."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From after the host up to ?, # or the end; null or no ://: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What is one url for aliases: host, path and query, without scheme and fragment; null where there is no ://."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), rest))


def absolute(link: Column, base: Column) -> Column:
    """A link as an absolute url, seen from the page it stands on."""
    origin = F.regexp_extract(base, r"(?s)\A(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)\A(.*?:)//", 1)
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): urls made aliases by canonical links and by redirects (meta refresh) in the html of pages (url, html)."""
    marked = pages.filter(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh"))
    found = lambda tag, url: F.transform(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, url, 1))
    targets = F.concat(found(LINK, HREF), found(REFRESH, REFRESH_URL))
    links = marked.select("url", F.explode(targets).alias("link")).filter("link <> ''")
    edges = links.select(node_of(F.col("url")).alias("a"), node_of(absolute(F.col("link"), F.col("url"))).alias("b"))
    return edges.filter("a <> b").distinct()


def match_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """(node, rule, verdict) for the nodes (node, host, path) that a rule fits: the longest one.

    rules: host, path, verdict. A rule fits its host and all subdomains where the path starts with its
    own. Every suffix of a host is looked up, an equi-join that stays one for any number of rules. Of
    equally long rules the first by text wins, allow before block.
    """
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    at = nodes.select("node", "path", F.explode(suffixes).alias("suffix"))
    r = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "verdict")
    fits = at.join(r, "suffix").filter(F.startswith("path", "start"))
    rule = F.concat("suffix", "start")
    best = F.struct((-F.length(rule)).alias("size"), rule.alias("rule"), F.col("verdict"))
    return fits.groupBy("node").agg(F.min(best).alias("best")).select("node", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, component: a row for every row of pages (page_id, url, html).

    ``edges`` (a, b: urls) are further aliases, say from a crawl log. Null urls and urls without :// have
    empty host and path, no alias and the verdict allow. Repeated rows are judged alike.
    """
    links = page_edges(pages)
    if edges is not None:
        links = links.unionByName(edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b"))).distinct()
    page = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    alias = connected_components(links, native=True)

    split = F.split(F.col("node"), "[/?]", 2)
    linked = alias.select(
        "node", split[0].alias("host"), F.regexp_extract("node", r"(?s)\A[^/?]*([^?]*)", 1).alias("path")
    )
    decided = alias.join(match_rules(linked, rules), "node")
    of_component = decided.groupBy("component").agg(F.max(F.when(F.col("verdict") == "allow", 2).otherwise(1)).alias("strongest"))
    spread = alias.join(of_component, "component", "left").select("node", "component", "strongest")

    places = page.filter("host <> ''").select(F.struct("host", "path").alias("node"), "host", "path").distinct()
    own = match_rules(places, rules).select(F.col("node.host").alias("host"), F.col("node.path").alias("path"), "rule", F.col("verdict").alias("own"))
    judged = page.join(own, ["host", "path"], "left").join(spread, "node", "left")
    verdict = F.coalesce("own", F.when(F.col("strongest") == 1, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")
