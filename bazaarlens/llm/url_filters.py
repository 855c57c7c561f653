"""URL filters that follow redirects: a page is judged by its own rule, else by its aliases.

DataFrame functions only. Rules are found by equality joins: a URL meets the rules of its host and
of each parent domain under the path prefixes of just the lengths that those rules have. Each
(host, path) is judged once. Redirect and canonical links make a graph of URLs; a
component with a blocked URL blocks its pages without a rule, unless it also has an allowed one.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.components import connected_components
from bazaarlens.session import materialize

_AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER_SCHEME, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _AFTER_SCHEME, 2)


def _ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of each distinct (host, path) that a rule fits; the longest wins.

    Of equally long rules the one with the longer host wins, then allow.
    """
    rules = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    ).where("rule_host is not null and rule_path is not null and rule_verdict in ('allow', 'block')")
    # Stored, as what is joined to hot hosts and addresses must come straight from a shuffle to be spread.
    lengths = materialize(rules.groupBy("rule_host").agg(F.collect_set(F.char_length("rule_path")).alias("lengths")))
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    candidates = (
        addresses.distinct()
        .withColumn("rule_host", F.explode(suffixes))
        .join(lengths, "rule_host")
        .withColumn("length", F.explode("lengths"))
        .where(F.char_length("path") >= F.col("length"))
        .withColumn("rule_path", F.expr("substring(path, 1, length)"))
    )
    rank = F.struct(
        F.char_length(F.concat("rule_host", "rule_path")).alias("all"),
        F.char_length("rule_host").alias("host"),
        (F.col("rule_verdict") == "allow").alias("allow"),
    )
    best = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank)
    return (
        candidates.join(rules, ["rule_host", "rule_path"])
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )


def _address(url: Column) -> Column:
    """A URL without its fragment, as a node of the graph."""
    return F.regexp_replace(url, r"(?s)#.*$", "")


_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
# In the content of a refresh: seconds, then the target, mostly behind url=.
_REFRESH_URL = r"""(?is)^\s*(?:[\d.]+[;,\s]+(?:url\s*=\s*)?|[;,\s]*url\s*=\s*)(?:"([^"]*)|'([^']*)|([^"'\s;,]\S*))"""
# One of the names of a link's relation, in any quotes or none.
_CANONICAL = r"""(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'|canonical(?:\s|/|>))"""
_REFRESH = r"""(?:"\s*refresh\s*"|'\s*refresh\s*'|refresh(?:\s|/|>))"""


def _attribute(name: str) -> str:
    return rf"(?is)(?:^|[^\w-]){name}\s*=\s*{_VALUE}"


def _tags(tag: str, attribute: str, value: str) -> Column:
    """The tags, outside of comments, whose attribute has the value."""
    commented = F.contains(F.col("html"), F.lit("<!--"))
    shown = F.when(commented, F.regexp_replace("html", r"(?s)<!--.*?(?:-->|\z)", "")).otherwise(F.col("html"))
    # A value without quotes may end with the tag itself.
    return F.regexp_extract_all(shown, F.lit(rf"(?is)<{tag}\b[^>]*\b{attribute}\s*=\s*{value}[^>]*>?"), F.lit(0))


def _first_group(texts: Column, pattern: str) -> Column:
    """Of each text, what one of the pattern's three groups holds in its first match; else empty."""
    return F.transform(texts, lambda t: F.concat(*[F.regexp_extract(t, pattern, group) for group in (1, 2, 3)]))


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target) of canonical links and meta refreshes in ``html``, targets made absolute.

    Every such tag of a page counts, but for those in comments; values may stand in either quotes or in none, and
    canonical may be one of several relations.
    A target that is neither absolute nor begins with a slash is taken from the page's last slash on.
    """
    canonical = _first_group(_tags("link", "rel", _CANONICAL), _attribute("href"))
    content = _first_group(_tags("meta", "http-equiv", _REFRESH), _attribute("content"))
    content = F.transform(content, lambda c: F.replace(F.replace(c, F.lit("&quot;"), F.lit('"')), F.lit("&#39;"), F.lit("'")))
    refresh = _first_group(content, _REFRESH_URL)
    targets = (
        pages.where("url is not null and html is not null")
        .select(F.col("url"), F.explode(F.array_distinct(F.concat(canonical, refresh))).alias("target"))
        .withColumn("target", F.trim(F.replace("target", F.lit("&amp;"), F.lit("&"))))
        .where("target != ''")
    )
    target, scheme = F.col("target"), F.regexp_extract("url", r"(?s)^(.*?:)//", 1)
    site = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    absolute = (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(scheme, target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(folder, target))
    )
    return targets.select(F.col("url").alias("source"), absolute.alias("target"))


def judged_pages(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (null if none fits) and verdict (allow or block) of every page.

    ``pages`` has page_id, url and html, ``rules`` host, path and verdict, and ``redirects``, if
    given, source and target URLs that a crawl has seen. A page without rule and without aliases is
    allowed, so is one with a null url. Repeated rows give repeated results; null html has no links, very long html is searched whole;
    further columns are ignored. Empty pages give no rows, empty rules allow all.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target").where("source is not null and target is not null"))
    links = links.select(_address(F.col("source")).alias("a"), _address(F.col("target")).alias("b"))
    members = connected_components(links)

    addresses = pages.select(url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    aliases = members.select("component", url_host(F.col("node")).alias("host"), url_path(F.col("node")).alias("path"))
    by_rule = materialize(_ruled(addresses.unionByName(aliases.select("host", "path")), rules))
    decided = aliases.join(by_rule, ["host", "path"]).groupBy("component").agg(
        F.when(F.bool_or(F.col("verdict") == "allow"), "allow").otherwise("block").alias("of_aliases")
    )
    by_alias = members.join(decided, "component").select(F.col("node").alias("_node"), "of_aliases")
    return (
        pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .join(by_rule, ["host", "path"], "left")
        .join(by_alias, _address(F.col("url")) == F.col("_node"), "left")
        .select("page_id", "host", "path", "rule", F.coalesce("verdict", "of_aliases", F.lit("allow")).alias("verdict"))
    )
