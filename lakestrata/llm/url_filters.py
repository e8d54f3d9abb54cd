"""URL filters with redirect equivalence: block decisions reach every alias of a page.

Two URLs are aliases when a chain of redirects (``<meta http-equiv=refresh>``) and canonical links
(``<link rel=canonical>``) joins them; URLs that differ only in scheme or fragment are one node.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SITE = "://([^/?#]*)([^?#]*)"
TAG = r"(?is)<(?:link|meta)\b[^>]*\b(?:canonical|refresh)\b[^>]*>"
CANONICAL = r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b"""
REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
BASE = r"""(?is)<base\s(?:[^>]*\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
DOTS = r"^[^?]*/\.\.?(?:[/?]|\z)"
TARGET = r"""(?is)\burl\s*=\s*['"]?\s*([^"'>\s]+)"""


class Rule(NamedTuple):
    """``site`` is ``host/path prefix``; it fits the host, its subdomains, and paths that start so."""

    verdict: str
    site: str


def host_of(url: str) -> Column:
    """A-Z lower-cased host after the first ``://``; empty for NULL or a URL without one."""
    return F.translate(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), SITE, 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), SITE, 2)


def rule_of(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """The fitting rule as a struct (site, verdict), NULL without one.

    The longest wins; of equally long ones the one with the longer host, then a block.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.site), -len(r.site.partition("/")[0]), r.verdict != "block", r.site))
    found = []
    for rule in ranked:
        site, slash, rest = rule.site.partition("/")
        fits = (F.col(host) == site) | F.col(host).endswith("." + site)
        named = F.struct(F.lit(rule.site).alias("site"), F.lit(rule.verdict).alias("verdict"))
        found.append(F.when(fits & F.col(path).startswith(slash + rest), named))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<site:string,verdict:string>")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` written into the plan once."""
    return F.get(F.transform(F.array(value), use), 0)


def _without_dots(node: Column) -> Column:
    """A node whose path has no ``.`` and ``..`` segments (RFC 3986, 5.2.4); others come back as they are."""
    none = F.array().cast("array<string>")

    def walk(kept: Column, s: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(s == ".", kept).when(s == "..", up).otherwise(F.concat(kept, F.array(s)))

    def rebuilt(parts: Column) -> Column:
        end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        walked = F.aggregate(F.slice(parts, 2, F.size(parts)), none, walk)
        return F.concat(F.get(parts, 0), F.lit("/"), F.array_join(F.concat(walked, end), "/"))

    parts = F.split(F.regexp_extract(node, "(?s)^[^?]*", 0), "/", -1)
    return F.when(node.rlike(DOTS), F.concat(_once(parts, rebuilt), F.regexp_extract(node, r"(?s)\?.*$", 0))).otherwise(node)


def node_of(url: Column) -> Column:
    """The graph node of a URL: host, path without dot segments, query; NULL where there is no host."""
    rest = F.regexp_extract(url, "(?s)://([^#]*)", 1)
    host = F.translate(F.regexp_extract(rest, "^[^/?]*", 0), UPPER, LOWER)
    tail = F.regexp_extract(rest, "(?s)^[^/?]*(.*)$", 1)
    tail = F.when(tail == "", "/").when(tail.startswith("?"), F.concat(F.lit("/"), tail)).otherwise(tail)
    return _once(F.when(host != "", F.concat(host, tail)), _without_dots)


def resolved(base: Column, href: Column) -> Column:
    """``href`` as an absolute URL, seen from the page at ``base``."""
    href = F.trim(F.replace(href, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(base, "^([^:/?#]*):", 1)
    site = F.regexp_extract(base, "^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, "^[^:/?#]*://[^/?#]*(?:/[^?#]*/|/)?", 0)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(base, "^[^?#]*", 0), href))
        .when((href == "") | href.startswith("#"), base)
        .otherwise(F.concat(folder, href))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(source, target)`` nodes of every redirect and canonical link in ``pages``.

    Relative targets are seen from the page's first ``<base href>``, if it names a site, else from the page.
    """
    found = pages.select(F.col(url).alias("_url"), F.col(html).alias("_html"), F.explode(F.regexp_extract_all(html, F.lit(TAG), F.lit(0))).alias("_tag"))
    named = F.concat(*(F.regexp_extract("_html", BASE, k) for k in (1, 2, 3)))
    seen = lambda name: _once(resolved(F.col("_url"), name), lambda b: F.when(b.contains("://"), b))
    base = _once(named, lambda name: F.when(name != "", seen(name)))
    tags = found.select("_url", "_tag", F.coalesce(base, F.col("_url")).alias("_base"))
    tag = F.col("_tag")
    href = F.concat(*(F.regexp_extract(tag, HREF, k) for k in (1, 2, 3)))
    target = F.when(tag.rlike(CANONICAL) & (href != ""), href).when(
        tag.rlike(REFRESH) & tag.rlike(TARGET), F.regexp_extract(tag, TARGET, 1)
    )
    links = tags.select("_url", "_base", target.alias("_href")).filter("_href is not null")
    target = _once(F.col("_base"), lambda b: _once(F.col("_href"), lambda h: _once(resolved(b, h), node_of)))
    edges = links.select(node_of(F.col("_url")).alias("source"), target.alias("target"))
    return edges.filter("source is not null and target is not null and source <> target")


def inherited(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(node, passed_on)`` for every node with an alias: what its group of aliases decides.

    A group with an explicitly allowed member passes on ``allow``, else one with a blocked member
    passes on ``block``; other groups pass on nothing (NULL).
    """
    groups = components(edges, "source", "target")
    ruled = groups.select(
        "component", F.regexp_extract("node", "^[^/]*", 0).alias("host"), F.regexp_extract("node", "(?s)^[^/]*([^?]*)", 1).alias("path")
    ).select("component", rule_of(rules)["verdict"].alias("verdict"))
    decided = ruled.groupBy("component").agg(
        F.when(F.max(F.col("verdict") == "allow"), "allow").when(F.max(F.col("verdict") == "block"), "block").alias("passed_on")
    )
    return groups.join(decided, "component").select("node", "passed_on")


def judge_pages(pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every row of ``pages`` as ``(key, host, path, rule, verdict, passed_on)``.

    The verdict is the page's own rule's; without a rule what its aliases pass on (see
    ``inherited``), else ``allow``. NULL or malformed URLs have empty host and path, no alias and
    the verdict ``allow``; repeated rows stay, other columns are ignored.
    """
    own = pages.select(key, F.col(url).alias("_url")).select(
        key,
        host_of("_url").alias("host"),
        path_of("_url").alias("path"),
        F.coalesce(node_of(F.col("_url")), F.concat(F.lit("#"), F.col(key).cast("string"))).alias("node"),
    )
    judged = own.withColumn("_rule", rule_of(rules)).join(inherited(alias_edges(pages, url, html), rules), "node", "left")
    return judged.select(
        key,
        "host",
        "path",
        F.col("_rule.site").alias("rule"),
        F.coalesce("_rule.verdict", "passed_on", F.lit("allow")).alias("verdict"),
        "passed_on",
    )
