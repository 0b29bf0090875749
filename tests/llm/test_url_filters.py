import random
import re

import pytest
from pyspark.sql import functions as F

from slipstream.llm import queries
from slipstream.llm.url_filters import ALLOW, BLOCK, RULES, Rule, judged, kept, page_links
from tests.llm.conftest import same

SCHEMA = "page_id long, url string, html string, node string, rule string, verdict string, host string, alias string, rule_no string, component string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, *[None] * 7) for r in rows], SCHEMA).repartition(2)


def link(target):
    return f"<html><head><link rel='canonical' href='{target}'></head></html>"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def best(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=lambda r: (-len(r.text), r.verdict != ALLOW, rules.index(r)), default=None)


def brute(rows, links, rules=RULES):
    group = {}
    find = lambda x: x if group.setdefault(x, x) == x else find(group[x])
    for a, b in links:
        group[find(a)] = find(b)
    bad = {find(u) for u in list(group) if (r := best(u, rules)) and r.verdict == BLOCK}
    out = []
    for i, url, _ in rows:
        rule = best(url, rules)
        other = BLOCK if url in group and find(url) in bad else ALLOW
        out.append((i, *parts(url), rule and rule.text, rule.verdict if rule else other))
    return out


def test_urls(pages):
    rows = [
        (1, "http://a.NET/x", ""), (2, "http://net", None), (3, "https://Example.net/en/1?u=/x#y", ""), (4, "https://badexample.net/en/1", "<p>"),
        (5, "http://m.example.com/de/1", ""), (6, "http://example.com/d", ""), (7, "https://x.org/fr/", ""), (8, "https://x.org?/fr/", ""), (9, None, None), (None, "", ""),
        (10, "no scheme.net/", ""), (11, "http://a.net:80/x", ""), (12, "a://b://c.net/x", ""), (12, "a://b://c.net/x", ""), (13, "http://É.net/É", ""), (14, "://net/", "x" * 300_000),
    ]
    same(judged(pages(rows)).collect(), brute(rows, []))


def test_equally_long_rules(pages):
    rules = (Rule(BLOCK, "b.c", "/"), Rule(ALLOW, "c", "/bb"[:3]), Rule(ALLOW, "b.c", "/"), Rule(BLOCK, "c", "/b"))
    rows = [(1, "http://a.b.c/bb", ""), (2, "http://c/bb", ""), (3, "http://c/bx", "")]
    same(judged(pages(rows), rules).collect(), brute(rows, [], rules))
    assert {r["verdict"] for r in judged(pages(rows), ()).collect()} == {ALLOW}


def test_blocks_reach_aliases_but_no_explicit_allow(pages, spark):
    rng = random.Random(3)
    urls = [f"http://{h}/{p}{k}" for k in range(40) for h, p in (("a.info", ""), ("a.net", ""), ("example.net", "en/"), ("b.org", "fr/"), ("c.org", ""))]
    links, rows = [], []
    for k, url in enumerate(urls):
        target = rng.choice(urls) if rng.random() < 0.4 else None
        rows.append((k, url, link(target) if target else "<p>text"))
        links += [(url, target)] if target else []
    more = [(rng.choice(urls), f"http://elsewhere.com/{k}") for k in range(10)] + [("http://elsewhere.com/3", "http://q.net/"), (None, "http://a.info/1"), ("http://a.info/2", None)]
    redirects = spark.createDataFrame(more, "source string, target string")
    want = brute(rows, links + [m for m in more if None not in m])
    same(judged(pages(rows), redirects=redirects).collect(), want)
    assert {(w[3], w[4]) for w in want} >= {(None, BLOCK), (None, ALLOW), ("example.net/en/", ALLOW)}
    left = kept(pages(rows), redirects=redirects)
    assert left.columns == pages(rows).columns
    assert sorted(r["page_id"] for r in left.collect()) == sorted(w[0] for w in want if w[4] == ALLOW)


def test_links_of_pages(pages):
    found = lambda html, url="http://H.com/a/b?c#d": [r["target"] for r in page_links(pages([(1, url, html)])).collect()]
    assert found('<LINK href="/x?a=1&amp;b=2#f" REL=Canonical>') == ["http://h.com/x?a=1&b=2"]
    assert found("<link rel='next canonical' href=y>") == ["http://h.com/a/y"]
    assert found('<meta http-equiv="Refresh" content="0; URL=\'//Z.org/q\'">') == ["http://z.org/q"]
    assert found('<link rel=canonical href="?p=2">') == ["http://h.com/a/b?p=2"]
    assert found('<link rel=canonical href="y">', "http://h.com") == ["http://h.com/y"]
    for none in ['<!-- <link rel=canonical href="/x"> -->', '<script>"<link rel=canonical href=/x>"</script>', "<link rel=stylesheet href=/x>", "<link rel=canonical>",
                 '<link rel=canonical href="mailto:x">', '<link rel=canonical href="#x">', '<link rel=canonical href="http://h.com/a/b?c">', '<meta name=x content="url=/y">']:
        assert found(none) == []


def test_hub_of_aliases(pages):
    rows = [(k, f"http://a.info/{k}", link("http://hub.net/x" if k % 2 else "http://hub.org/x")) for k in range(3000)]
    got = judged(pages(rows)).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {BLOCK: 1500, ALLOW: 1500}


def test_empty_table_and_no_python_workers(pages):
    found = judged(pages([]))
    assert found.count() == 0
    assert not re.search("Python|Arrow|Pandas", found._jdf.queryExecution().toString())
    assert "op13_url_filters" in queries.ORACLE_SQL and F is not None
