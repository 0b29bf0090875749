import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from slipstream.llm import simhash_dedup as S
from slipstream.llm.components import components
from tests.llm.conftest import lower, pairs, rows, same, words_of


def brute_fingerprint(text):
    words = words_of(lower(text))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(docs):
    marks = [(i, brute_fingerprint(t)) for i, t in docs]
    group = {f: f for _, f in marks}

    def root(f):
        while group[f] != f:
            f = group[f]
        return f

    prints = list(group)
    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= 3:
                group[root(a)] = root(b)
    least = {}
    for i, f in marks:
        if i is not None:
            least[root(f)] = min(i, least.get(root(f), i))
    return [(i, f"{f:016x}", least.get(root(f))) for i, f in marks]


def found(docs):
    return rows(S.near_duplicates(docs).withColumn("fingerprint", S.as_hex(F.col("fingerprint"))), "doc_id", "fingerprint", "component_id")


def test_odd_rows(odd):
    same(found(odd), brute(pairs(odd)))


def test_small_table(small):
    same(found(small), brute(pairs(small)))


def test_empty_table(table):
    assert found(table([])) == []
    assert S.one_of_each(table([])).count() == 0


def test_full_keys_are_divided_and_lose_nothing(spark):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    prints = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(200)}
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    nodes = spark.createDataFrame([(f, k) for k, f in enumerate(signed)], "fp long, node long")
    for distance in (0, 1, 3, 5):
        group = list(range(len(signed)))

        def root(k, group=group):
            while group[k] != k:
                k = group[k]
            return k

        for a in range(len(signed)):
            for b in range(a):
                if ((signed[a] ^ signed[b]) & (1 << 64) - 1).bit_count() <= distance:
                    x, y = root(a), root(b)
                    group[max(x, y)] = min(x, y)
        want = {k: root(k) for k in range(len(group)) if root(k) != k}
        got = {r["node"]: r["component"] for r in components(S.links(nodes, distance, block=4)).collect()}
        assert {k: v for k, v in got.items() if k != v} == want


def test_every_near_pair_shares_a_key():
    rng = random.Random(1)
    for distance in range(1, 8):
        plan = S._plan(distance)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, distance)))
            keys = [(s, m) for s, m in plan if (a ^ b) & S._bits(m) & (1 << 64) - 1 == 0]
            starts = np.array([s for s, _ in keys])
            both = [np.full(len(keys), x, np.uint64) for x in (a, b)]
            assert S.within_budget(*both, starts, distance).any()


def test_one_of_each_keeps_the_smallest_id_and_all_columns(odd):
    left = S.one_of_each(odd)
    assert left.columns == odd.columns
    components_of = {(i, c) for i, _, c in brute(pairs(odd))}
    ids = [i for i, _ in pairs(left)]
    kept = {c for i, c in components_of if i == c and i is not None}
    assert sorted(pairs(left.where("doc_id is not null")), key=repr) == sorted({(i, t) for i, t in pairs(odd) if i in kept}, key=repr)
    assert {t for i, t in pairs(left) if i == 18} == {"x", "y z"}  # two texts of one id are no repeat
    assert ids.count(None) == 2


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 500), (None, 3), (7, 8)], "a long, b long")
    assert {(r["node"], r["component"]) for r in components(chain).collect()} == {(k, 0) for k in range(201)}
