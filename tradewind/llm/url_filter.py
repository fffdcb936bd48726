"""URL filters over redirect equivalence.

A rule allows or blocks a host, its subdomains and the paths below a prefix; the longest
rule that fits a url decides it. Urls that redirect or point to one another (canonical
links and refresh targets in the pages, and any redirects given) are aliases: a block
reaches all of them through connected components, unless one of them is allowed explicitly.
A url's own rule comes before what its aliases bring.

DataFrame operations only. Rules meet urls in a join on host suffixes, so their number is
not limited; components are found by star steps that never gather a node's links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import components, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ://, or the empty string."""
    at = F.position(F.lit("://"), url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The url as a node: without scheme, fragment and default port, host in lower case."""
    after = F.regexp_extract(_rest(url), "^[^/?#]*([^#]*)", 1)
    return F.concat(F.regexp_replace(host_of(url), ":(80|443)$", ""), after)


def _link(tag: Column) -> Column:
    """The target in a canonical link or refresh tag, or the empty string."""
    quoted = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    href = F.concat(*(F.regexp_extract(tag, r"(?i)\bhref" + quoted, i) for i in (1, 2, 3)))
    refresh = F.regexp_extract(tag, r"""(?i)\burl\s*=\s*["']?([^"'>\s]+)""", 1)
    return F.replace(F.when(tag.rlike("(?i)^<link"), href).otherwise(refresh), F.lit("&amp;"), F.lit("&"))


def _absolute(target: Column, url: Column) -> Column:
    scheme = F.regexp_extract(url, r"^([^:/?#]*)://", 1)
    root = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(url), r"^(.*/)?", 0)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


#: A link or meta tag that names a canonical or refresh target.
TAG = r"""(?i)<(?:link\b[^>]*\brel\s*=\s*["']?canonical\b|meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>"""


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): nodes of pages and of the targets that their html names as the same page."""
    tags = F.regexp_extract_all("html", F.lit(TAG), F.lit(0))
    return (
        pages.where(F.col("html").rlike(TAG))
        .select("url", F.explode(F.transform(tags, _link)).alias("target"))
        .where("target <> '' AND locate('://', url) > 0")
        .select("url", _absolute(F.col("target"), F.col("url")).alias("target"))
    )


def matched(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, action, rule) of the longest rule that fits host and path; allow wins ties."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fits = (
        urls.where("host <> ''")
        .select(key, "path", F.explode(suffixes).alias("rule_host"))
        .join(rules, "rule_host")
        .where(F.startswith("path", "rule_path"))
        .withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    return fits.groupBy(key).agg(
        F.max(F.struct(F.length("rule").alias("size"), (F.col("action") == "allow").alias("allowed"), "rule")).alias("best")
    ).select(
        key, F.when(F.col("best.allowed"), "allow").otherwise("block").alias("action"), F.col("best.rule").alias("rule")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of pages.

    ``rules``: (action, host, path); ``redirects``: (from_url, to_url). Null urls and urls
    without :// have empty host and path, fit no rule, have no aliases and are allowed; null
    html has no links. Repeated rows give equal results; links to urls that are no pages
    count, since those can fit a rule too. A link of a page to itself changes nothing.
    """
    rules = rules.select("action", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
    url = F.coalesce(F.col("url"), F.lit(""))
    own = stored(
        pages.select(
            F.monotonically_increasing_id().alias("uid"), "page_id", url.alias("url"),
            host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"),
        ),
        "url-pages",
    )
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("from_url").alias("url"), F.col("to_url").alias("target")))
    links = stored(links.where("url IS NOT NULL AND target IS NOT NULL"), "url-links")
    ends = links.select("url").unionByName(links.select(F.col("target").alias("url"))).distinct()
    ends = ends.select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"), "url"
    )
    best = stored(own.join(matched(own, rules, "uid"), "uid", "left"), "url-rules")
    decided = best.where("action IS NOT NULL").select("node", "action").unionByName(
        ends.join(matched(ends, rules, "url"), "url").select("node", "action")
    )
    groups = components(
        links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")).where("a <> '' AND b <> ''"),
        "url",
    )
    groups = stored(groups, "url-groups")

    def state(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(
            F.max(F.col("action") == "block").alias("blocked"), F.max(F.col("action") == "allow").alias("allowed")
        )

    nodes = decided.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node"))
    reached = stored(state(nodes, "c").where("blocked AND NOT allowed").select("c", F.lit(True).alias("reached")), "url-blocked")
    return (
        best.join(groups, "node", "left")
        .withColumn("c", F.coalesce("component", "node"))
        .join(reached, "c", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("action", F.when(F.col("reached") & (F.col("node") != ""), "block"), F.lit("allow")).alias("verdict"),
        )
    )
