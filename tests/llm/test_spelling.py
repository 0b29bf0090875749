import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from slipstream.llm import spelling
from tests.llm.conftest import lower, pairs, same


def edits(word, alphabet):
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet} | {a + c + b[1:] for a, b in cuts if b for c in alphabet} - {word}


def counted(rows, slips, least, at_least):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            found[run[: h % len(run)] + run[h % len(run) + 1 :] if h % slips == 0 else run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= at_least}


def brute(words, ratio=5):
    alphabet = sorted(set("".join(words)))
    form, near = {}, {}
    for w, n in words.items():
        found = sorted((-words[v], v) for v in edits(w, alphabet) if v in words and v != w)
        near[w] = len(found)
        form[w] = found[0][1] if found and -found[0][0] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words.get(form[w])))
    return out


@pytest.mark.parametrize("which,slips,least,at_least", [("odd", 199, 6, 5), ("odd", 3, 2, 1), ("small", 199, 6, 5), ("small", 7, 6, 2)])
def test_tables(which, slips, least, at_least, request):
    docs = request.getfixturevalue(which)
    words = counted(pairs(docs), slips, least, at_least)
    got = spelling.grouped(docs, slips=slips, least_length=least, least_count=at_least).collect()
    same(got, brute(words))


@pytest.mark.parametrize("most,letters,queries", [(1 << 13, 1 << 17, 1 << 15), (7, 1 << 17, 1 << 15), (50, 100, 13)])
def test_near_words_in_cells_of_any_size(spark, most, letters, queries, monkeypatch):
    monkeypatch.setattr(spelling, "LETTERS", letters)
    monkeypatch.setattr(spelling, "QUERIES", queries)
    rng = random.Random(most)
    words = {"".join(rng.choices("abé", k=rng.randint(6, 8))) for _ in range(500)} | {"aaaaaa" + "".join(rng.choices("abcd", k=6)) for _ in range(300)} | {"x" * 300, "x" * 299 + "y", "x" * 301}
    words = {w: rng.randint(1, 60) for w in words}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = {r["word"]: (r["n_near"], r["near_n"], r["near_word"]) for r in spelling.near_words(frame, most=most).collect()}
    want = {}
    for w in words:
        found = sorted((-words[v], v) for v in edits(w, "abcdéxy") if v in words and v != w)
        if found:
            want[w] = (len(found), -found[0][0], found[0][1])
    assert got == want


def test_index_against_all_pairs():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(2, 7))) for _ in range(120)})
    queries = ["".join(rng.choices("abz", k=rng.randint(2, 7))) for _ in range(80)]
    exact = np.array([rng.randint(0, len(q)) for q in queries])
    got = set(zip(*(x.tolist() for x in spelling.Index(words).near(queries, exact)), strict=True))
    want = set()
    for q, query in enumerate(queries):
        e = int(exact[q])
        for k, word in enumerate(words):
            if word.endswith(query[len(query) - e :]) and word[: len(word) - e] in edits(query[: len(query) - e], "abz") - {query[: len(query) - e]}:
                want.add((q, k))
    assert got == want


def test_chains_of_forms(table):
    words = {"stopping": 5000, "stoping": 900, "stpoing": 3, "stoing": 120, "toing": 9, "toingg": 9}
    docs = table([(k, " ".join([w] * n)) for k, (w, n) in enumerate(words.items())])
    got = {r["word"]: r for r in spelling.grouped(docs, slips=10**9 + 7, least_length=5, least_count=3).collect()}
    same(got.values(), brute(words))
    assert got["toing"]["root"] == "stopping" and got["toing"]["form"] == "stoing"


def test_empty_table_and_texts(table):
    assert spelling.grouped(table([])).count() == 0
    assert spelling.grouped(table([(1, None), (2, ""), (3, "1 2 3 ×÷ short")])).count() == 0
