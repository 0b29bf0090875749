import math
import zlib
from collections import Counter

import numpy as np
import pytest

from slipstream.llm import ppm
from tests.llm.conftest import lower, pairs, words_of


def tokens(text):
    return [*words_of(lower(text)), None]


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def symbols(text):
    return [*" ".join(words_of(lower(text))).encode(), ppm.END]


class Brute:
    """The same model by dictionaries of contexts."""

    def __init__(self, texts):
        self.context = [{} for _ in range(ppm.ORDER + 1)]
        for t in texts:
            s = [ppm.END] * ppm.ORDER + symbols(t)
            for j in range(ppm.ORDER, len(s)):
                for k in range(ppm.ORDER + 1):
                    self.context[k].setdefault(tuple(s[j - k : j]), Counter())[s[j]] += 1

    def symbol(self, s, j):
        shut, p = set(), 0.0
        for k in range(ppm.ORDER, -1, -1):
            seen = self.context[k].get(tuple(s[j - k : j]))
            if not seen:
                continue
            left = {x: n for x, n in seen.items() if x not in shut}
            total = sum(left.values())
            if s[j] in left:
                return p + math.log10((2 * left[s[j]] - 1) / (2 * total))
            if left:
                p += math.log10(len(left) / (2 * total))
            shut |= set(seen)
        return p - math.log10(max(ppm.SYMBOLS - len(shut), 1))

    def text(self, t):
        s = [ppm.END] * ppm.ORDER + symbols(t)
        return sum(self.symbol(s, j) for j in range(ppm.ORDER, len(s)))


def check(docs):
    rows = pairs(docs)
    train = [t for i, t in rows if not held_out(i)]
    counts = Counter(w for t in train for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    model = Brute(train)
    want = {}
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        key = (i, held_out(i), len(w), sum(counts[x] > 0 for x in w), total)
        want.setdefault(key, []).append((base, model.text(t)))
    got = {}
    for r in ppm.scored(docs).collect():
        got.setdefault(tuple(r)[:5], []).append(tuple(r)[5:])
    assert set(got) == set(want)
    for key, scores in want.items():
        assert np.allclose(sorted(got[key]), sorted(scores), rtol=1e-5, atol=1e-4), key


def test_small_table(small):
    check(small.limit(60))


def test_odd_rows(odd):
    check(odd.where("length(text) < 10000 or text is null"))
    assert ppm.scored(odd).count() == odd.count()


def test_rare_tokens_are_counted_by_the_join(odd, monkeypatch):
    monkeypatch.setattr(ppm, "FREQUENT", 8)
    check(odd.where("length(text) < 10000 or text is null"))


def test_nothing_to_learn_from(table):
    assert ppm.scored(table([])).count() == 0
    held = next(i for i in range(50) if held_out(i))
    row = ppm.scored(table([(held, "ab c"), (held, "ab c")])).collect()
    assert [tuple(r)[:5] for r in row] == [(held, True, 3, 0, 0)] * 2
    assert all(r["score"] < 0 for r in row)


MANY_BYTES = [
    "Быстрая лиса перепрыгнула через ленивую собаку. Быстрая собака", "敏捷的棕色狐狸跳过了懒狗。敏捷的狗", "🙂🙃 🙂🙂 🦊🐕 🙂🙃", "ещё одна быстрая лиса и собака 敏捷的 🦊", "a\0b \x01\x7f ÿþ é",
]


def test_texts_of_many_bytes(table):
    """Bytes beyond the frequent ones of Latin text are symbols and contexts of their own."""
    check(table([(i, MANY_BYTES[i % len(MANY_BYTES)] + " " * (i % 2) + "ж狐🦊"[i % 3]) for i in range(40)]))


def test_probabilities_of_a_context_add_up(spark, table, small):
    docs = table([(i, t) for i, t in enumerate(MANY_BYTES * 3)]).unionByName(small.limit(30).select("doc_id", "text"), allowMissingColumns=True).select("doc_id", "text")
    nodes, contexts = ppm.train(docs, held=1)
    symbols = [b for b in range(256) if b not in range(0x0A, 0x0E)]
    assert len(symbols) == ppm.SYMBOLS and ppm.END in symbols
    seen = [r["context"] for r in contexts[ppm.ORDER].orderBy("context").collect()]
    rng = np.random.default_rng(1)
    some = {*rng.choice(seen, 25).tolist(), *(int.from_bytes("狐狸".encode()[k : k + 5]) for k in (0, 1)), int.from_bytes(b"qqqqq")}
    keys = spark.createDataFrame([((c << 8) | b,) for c in some for b in symbols], "key long")
    sums = Counter()
    for r in ppm.probabilities(keys, nodes, contexts).collect():
        sums[r["key"] >> 8] += 10 ** r["logp"]
    assert len(sums) == len(some) and all(total == pytest.approx(1.0, abs=1e-6) for total in sums.values())


def test_scores_do_not_depend_on_what_is_broadcast(small):
    """With room for 1 or 500 nodes every other key takes the joins; the scores are those of the whole model."""
    docs = small.limit(60).select("doc_id", "text")
    want = {r["doc_id"]: r["score"] for r in ppm.scored(docs).collect()}
    for most in (1, 500):
        got = {r["doc_id"]: r["score"] for r in ppm.scored(docs, most_nodes=most).collect()}
        assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_better_than_single_tokens_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = ppm.scored(docs).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > rows["sum(base_score)"]
