import html
import math
import re

import numpy as np
import pytest

from slipstream.llm import html_extract as H

BODY = "A paragraph of the article that is long enough to count as its text, with words and more words."


def test_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in H.main_text(pages).collect()}
    for p in pages.collect():
        article = p["html"][p["html"].index("<article>") + 9 : p["html"].index("</article>")]
        blocks = re.split(r"</?(?:p|h1|br|b)>", article)
        want = " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["n_chars"], got[p["page_id"]]["url"]) == (want, len(want), p["url"])


@pytest.mark.parametrize(
    "page,want",
    [
        (f"<body><div id=top-menu><a href=1>Home</a></div><div class=wrap><div class=x><h2>T</h2><p>{BODY}<p>Short.</div>"
         f"<div class='side bar sidebar'><p>{BODY}</p></div></div>", f"T {BODY} Short."),
        (f"<main><form><p>{BODY}</p><input></form><p>a&amp;b &lt;i&gt; &eacute;&#233;</p><p>{BODY}</p><script>if(a<b){{}}</script></main>", f"a&b <i> éé {BODY}"),
        (f"<nav><ul><li>x<li>y<article><p>{BODY}</p><aside>{BODY}</aside><section id=comments><article class=comment><p>{BODY}{BODY}</p></article></section></article>", BODY),
        (f"<body><div class='cookie-notice'>{BODY}</div><header><h1>Site</h1></header><article><header><h1>Head  line</h1></header><p>wo<b>rd</b> {BODY}</p></article>", f"Head line word {BODY}"),
        ("plain   text\n only", "plain text only"),
        ("", ""), ("<p></p>", ""), ("<!-- a --><script>x</script>", ""),
        (f"<article><p>{BODY}<p>cut o", f"{BODY} cut o"),
        # two regions side by side, two articles, a heading beside the text, names that only contain such a word
        (f"<body><div class=content><p>{BODY}</p><p>{BODY}</p><p>{BODY}</p></div><div class=content><p>{BODY}</p><p>{BODY}</p></div></body>", " ".join([BODY] * 5)),
        (f"<body><article><p>{BODY}</p><p>{BODY}</p></article><article><p>{BODY}</p></article><footer>{BODY}</footer></body>", " ".join([BODY] * 3)),
        (f"<body><ul class=top-menu><li>Home</ul><div class=page-title><h1>The title</h1></div><div class=content><p>{BODY}</p><p>{BODY}</p></div></body>", f"The title {BODY} {BODY}"),
        (f'<article class="post form-article"><p>{BODY}</p></article>', BODY),
        (f"<article><p>{BODY}</p><div class=share-price>Shares cost 12 pounds.</div><div class=sidebar-left>{BODY}</div><p>{BODY}</p></article>", f"{BODY} Shares cost 12 pounds. {BODY}"),
    ],
)
def test_pages(page, want):
    assert H.extract(page) == want


def test_clusters_by_hand():
    """Ratios, smoothing, threshold and shares on a page without an article, by the definition."""
    blocks = ["x", "Menu", *[BODY] * 3, "a", "b", "c", "d", "e", "f", "g", BODY[:60], "h"]
    page = "<body>" + "".join(f"<div>{b}</div>" for b in blocks) + "</body>"
    parser = H.LineParser()
    parser.feed(page)
    parser.close()
    lines = [line for line in parser.lines if line.parts or line.tags]
    texts = [" ".join("".join(line.parts).split()) for line in lines]
    ratios = [len(t) / max(line.tags, 1) for t, line in zip(texts, lines, strict=True)]
    weights = [math.exp(-(k * k) / 2) for k in range(-2, 3)]
    smooth = [sum(w * ratios[j + k] for k, w in zip(range(-2, 3), weights, strict=True) if 0 <= j + k < len(ratios)) / sum(weights) for j in range(len(ratios))]
    mean = sum(smooth) / len(smooth)
    least = 0.5 * math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    groups, now = [], []
    for j, x in enumerate([*smooth, -1]):
        if x >= least:
            now.append(j)
        elif now:
            groups.append(now)
            now = []
    most = max(sum(len(texts[j]) for j in g) for g in groups)
    want = [False] * len(lines)
    for g in groups:
        for j in g:
            want[j] = ratios[j] > 0 and sum(len(texts[k]) for k in g) >= 0.1 * most
    assert H.clusters(np.array(ratios), np.array(list(map(len, texts)), float)).tolist() == want
    assert len(groups) == 2 and sum(want) < len(want)


def test_chunks_make_no_difference(monkeypatch):
    page = f"<html><body><nav>menu</nav><article><h1>A &amp; B</h1><p>{BODY}</p><p>x &lt; y &copy; z</p></article></body></html>"
    whole = H.extract(page)
    for size in (1, 3, 7, 64):
        monkeypatch.setattr(H, "FEED", size)
        assert H.extract(page) == whole


def test_smoothing_is_the_gaussian():
    ratios = np.array([0, 0, 10.0, 0, 0, 0])
    weight = np.exp(-np.array([4, 1, 0, 1, 4]) / 2)
    assert np.allclose(H.smoothed(ratios), [*(10 * weight / weight.sum()), 0])


def test_nulls_repeats_long_pages_and_empty_tables(spark):
    long = "<article>" + f"<p>{BODY}</p>" * 3000 + "</article>"
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", long, None), (2, "u", long, None), (3, "v", "<p>a", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r["page_id"] or 0, r["n_chars"]) for r in H.main_text(pages).collect()))
    assert got == [(0, 0), (1, 0), (2, 3000 * (len(BODY) + 1) - 1), (2, 3000 * (len(BODY) + 1) - 1), (3, 1)]
    assert H.main_text(pages.limit(0)).collect() == []
    assert H.main_text(pages).columns == ["page_id", "url", "text", "n_chars"]
