import hashlib
import random

import numpy as np
import pytest

from slipstream.llm import substring_dedup as D
from tests.llm.conftest import pairs, rows, same, words_of


def brute(docs):
    first = {}
    for i, t in docs:
        w = words_of(t)
        if i is not None:
            for k in range(len(w) - 49):
                window = tuple(w[k : k + 50])
                first[window] = min(i, first.get(window, i))
    out = []
    for i, t in docs:
        w = words_of(t)
        cover = [False] * len(w)
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k : k + 50])] < i:
                cover[k : k + 50] = [True] * 50
        kept = [x for x, c in zip(w, cover, strict=True) if not c]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def found(docs):
    return rows(D.deduplicated(docs).select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256"), "doc_id", "n_words", "n_removed", "kept_sha256")


def test_odd_rows(odd):
    same(found(odd), brute(pairs(odd)))
    assert D.deduplicated(odd).columns == [*odd.columns, "dedup"]


def test_small_table(small):
    same(found(small), brute(pairs(small)))


def test_empty_table(table):
    assert found(table([])) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_overlaps_of_few_words(table, seed):
    """Texts spliced from each other, over few words, so that runs and short repeats abound."""
    rng = random.Random(seed)
    texts = [[rng.choice("a b c d".split()) for _ in range(rng.randint(0, 120))] for _ in range(8)]
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(texts)
            at = rng.randint(0, len(t))
            parts += t[at : at + rng.randint(0, 90)] + [rng.choice("a b c d".split())] * rng.choice([0, 0, 1, 2, 3, 4, 60])
        texts.append(parts)
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rng.shuffle(docs)
    same(found(table(docs)), brute(docs))


def test_inner_symbols_do_not_depend_on_context():
    rng = np.random.default_rng(4)
    for _ in range(50):
        middle = rng.integers(0, 6, 120).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        cuts = []
        for _ in range(2):
            before, after = (rng.integers(0, 6, rng.integers(0, 40)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(2))
            names, at = D.symbols(np.concatenate([before, middle, after]), np.zeros(len(before) + 120 + len(after), int))
            at = at - len(before)
            inner = (at[:-1] >= D.MARGIN) & (at[1:] <= 120 - D.MARGIN)
            cuts.append(list(zip(at[:-1][inner].tolist(), at[1:][inner].tolist(), names[inner].tolist(), strict=True)))
        assert cuts[0] == cuts[1]


def test_without_repeats_keeps_columns_and_sets_lengths(odd):
    left = D.without_repeats(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    texts = {(r["doc_id"], r["n_chars"]) for r in left.collect() if r["doc_id"] == 4}
    assert texts == {(4, 0)}
