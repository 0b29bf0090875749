"""URL filtering by allow and block rules, with block decisions carried over to aliases.

A rule is a host and the beginning of a path; the longest rule that fits a URL decides it. URLs that one page names as its
canonical address, or sends its reader on to, are aliases: connected components over these links, and over any table of
redirects given, tell which URLs are one. An alias that no rule decides is blocked where its component has a blocked URL; an
explicit allow holds for the URLs it fits, whatever their aliases are. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import free_name
from slipstream.llm.components import components
from slipstream.llm.staging import staged

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/"))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What is after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The place in ``rules`` of the rule that decides; null if none fits. Of equally long ones an allow, then the earlier."""
    order = sorted(range(len(rules)), key=lambda k: (-len(rules[k].text), rules[k].verdict != ALLOW, k))
    found = F.lit(None).cast("int")
    for k in reversed(order):
        rule = rules[k]
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(k)).otherwise(found)
    return found


def node_of(url: Column) -> Column:
    """A URL as a node of links: the host lower-cased and no fragment; null without ``://``."""
    plain = F.regexp_extract(url, r"^[^#]*", 0)
    scheme = F.translate(F.substring_index(plain, "://", 1), _UPPER, _LOWER)
    rest = F.regexp_extract(_after_scheme(plain), r"^[^/?#]*([^#]*)", 1)
    return F.when(F.instr(plain, "://") > 0, F.concat(scheme, F.lit("://"), host_of(plain), rest))


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute: in quotes or without; empty if there is none."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def _resolved(target: Column, url: Column) -> Column:
    """An address found in the page ``url``, made absolute."""
    target = F.trim(F.replace(target, F.lit("&amp;"), F.lit("&")), F.lit(" \t\r\n"))
    scheme = F.substring_index(url, "://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .when((target == "") | F.startswith(target, F.lit("#")) | F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None))
        .when(F.startswith(target, F.lit("?")), F.concat(site, path_of(url), target))
        .otherwise(F.concat(site, folder, target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(source, target)``: the canonical address and the refresh target that each page names, as nodes.

    Comments and scripts are passed over. Pages without such a tag cost one search of their text.
    """
    own = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where(F.rlike("html", F.lit(r"(?i)<link\b|\bhttp-equiv\b")))
    clean = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script>", "")
    tags = own.select("url", F.explode(F.regexp_extract_all(clean, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.rlike("tag", F.lit(r"(?i)^<link\b")) & F.rlike(_attribute(F.col("tag"), "rel"), F.lit(r"(?i)(?:^|\s)canonical(?:\s|$)"))
    refresh = F.rlike("tag", F.lit(r"(?i)^<meta\b")) & F.rlike(_attribute(F.col("tag"), "http-equiv"), F.lit(r"(?i)^\s*refresh\s*$"))
    sent_to = F.regexp_extract(_attribute(F.col("tag"), "content"), r"""(?is)url\s*=\s*["']?([^"'\s]+)""", 1)
    target = F.when(canonical, _attribute(F.col("tag"), "href")).when(refresh, sent_to)
    links = tags.select("url", target.alias("target")).where("target is not null")
    return links.select(node_of(F.col("url")).alias("source"), node_of(_resolved(F.col("target"), F.col("url"))).alias("target")).where("source <> target").distinct()


def blocked_aliases(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(node)``: nodes of ``links(source, target)`` that no rule decides and that are one with a blocked URL."""
    members = staged(components(links.select(F.col("source").alias("a"), F.col("target").alias("b"))), "members")
    verdicts = _listed(rules, "verdict")
    ruled = members.withColumn("verdict", F.get(verdicts, rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)))
    blocked = ruled.where(F.col("verdict") == BLOCK).select("component").distinct()
    return ruled.where("verdict is null").join(blocked, "component", "left_semi").select("node").distinct()


def _blocked(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None, url: str, html: str) -> DataFrame:
    links = page_links(pages, url, html)
    if redirects is not None:
        more = redirects.select(node_of(F.col("source")).alias("source"), node_of(F.col("target")).alias("target"))
        links = links.unionByName(more.where("source <> target").distinct())
    return staged(blocked_aliases(links, rules), "blocked")


def _listed(rules: Sequence[Rule], field: str) -> Column:
    return F.array(*[F.lit(getattr(r, field)) for r in rules]).cast("array<string>")


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages``, repeated ones too.

    ``redirects(source, target)`` are further links between URLs; rows with a null in them say nothing. A null URL, or one
    without ``://``, has an empty host and path, fits no rule, has no alias and is allowed. A null or empty page names no
    other address. Very long pages and URLs are read whole. An empty table gives an empty result. Other columns, whatever
    their names, are not read. ``rules`` are part of the plan.
    """
    blocked = _blocked(pages, rules, redirects, url, html).withColumn("alias", F.lit(True))
    own = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), node_of(F.col(url)).alias("node"))
    found = own.withColumn("rule_no", rule_of(F.col("host"), F.col("path"), rules)).join(blocked, "node", "left")
    verdict = F.coalesce(F.get(_listed(rules, "verdict"), F.col("rule_no")), F.when(F.col("alias"), BLOCK).otherwise(ALLOW))
    return found.select("page_id", "host", "path", F.get(_listed(rules, "text"), F.col("rule_no")).alias("rule"), verdict.alias("verdict"))


def kept(pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The rows of ``pages`` that are allowed, with their columns. Rows are judged by their URL, so equal ids do not matter."""
    node, number, alias = (free_name(pages, name) for name in ("node", "rule_no", "alias"))
    blocked = _blocked(pages, rules, redirects, url, html).select(F.col("node").alias(node), F.lit(True).alias(alias))
    found = pages.withColumns({node: node_of(F.col(url)), number: rule_of(host_of(F.col(url)), path_of(F.col(url)), rules)}).join(blocked, node, "left")
    allowed = F.coalesce(F.get(_listed(rules, "verdict"), F.col(number)), F.when(F.col(alias), BLOCK).otherwise(ALLOW)) == ALLOW
    return found.where(allowed).select(*pages.columns)
