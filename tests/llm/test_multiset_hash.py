import hashlib
import random

from pyspark.sql import functions as F

from slipstream.llm import multiset_hash as M
from slipstream.llm.queries import op2_multiset_hash
from tests.llm.conftest import pairs, same


def paragraphs(text):
    return sorted(p for p in (text or "").split("\n") if p.strip(" \t\n\x0b\x0c\r"))


def brute(docs):
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    out = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        quarter = len(t) // 4
        edited = t[: len(t) - quarter] + following[:quarter]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edited_texts_of_distinct_ids(odd, small):
    """Ids are made distinct here; the order of rows with one id is by a hash."""
    seen = set()
    odd_ids = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    for docs in (odd_ids, small):
        got = M.edited_fingerprints(docs).select("doc_id", "n_chars", "edited_sha256").collect()
        same(got, brute(pairs(docs)))
        seen |= {r["doc_id"] for r in got}
    assert -5 in seen


def test_rows_nulls_and_empty(odd, table):
    assert M.edited_fingerprints(odd).count() == odd.count()
    assert M.edited_fingerprints(table([])).count() == 0
    one = M.edited_fingerprints(table([(7, "abcdefgh")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert one["next_vector"] == one["vector"]


def test_equal_exactly_for_equal_multisets_of_paragraphs(small, odd):
    for docs in (small, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = dict(pairs(docs))
        found = {r["doc_id"]: r["print"] for r in M.vectors(docs, ["doc_id"]).select("doc_id", M.as_hex(F.col("vector")).alias("print")).collect()}
        by_text, by_print = {}, {}
        for i, t in texts.items():
            by_text.setdefault(tuple(paragraphs(t)), set()).add(i)
            by_print.setdefault(found[i], set()).add(i)
        assert sorted(map(sorted, by_text.values())) == sorted(map(sorted, by_print.values()))


def test_insert_and_delete(spark):
    rng = random.Random(2)
    lines = [" ".join(rng.choice("abc def ghi. jkl mno! pqr".split()) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    a, b = "\n".join(lines[:25]), "\n".join(lines[25:])
    docs = spark.createDataFrame([("a", a), ("b", b), ("ab", "\n".join(reversed(lines))), ("none", "\n \n")], "id string, text string")
    v = {r["id"]: r["vector"] for r in M.vectors(docs, ["id"]).collect()}
    row = spark.createDataFrame([(v["a"], v["b"], v["ab"])], "a array<long>, b array<long>, ab array<long>")
    more, less = row.select(M.inserted(F.col("a"), F.col("b")), M.deleted(F.col("ab"), F.col("a"))).first()
    assert more == v["ab"] and less == v["b"]
    assert set(v["none"]) == {0}


def test_likeness_follows_shared_text(spark):
    near = op2_multiset_hash(spark, "/root/testdata/sf0.01").select("near_edited", "near_next").collect()
    assert all(0 <= x <= 1 for r in near for x in r)
    assert sum(r[0] > r[1] for r in near) >= 0.95 * len(near)
    docs = spark.createDataFrame([(k, ". ".join(f"s{j}" for j in range(k, k + 100))) for k in (0, 50, 200)], "id long, text string")
    v = {r["id"]: r["vector"] for r in M.vectors(docs, ["id"]).collect()}
    row = spark.createDataFrame([(v[0], v[50], v[200])], "a array<long>, b array<long>, c array<long>")
    same_, half, none = row.select(*[M.likeness(F.col("a"), F.col(x)) for x in "abc"]).first()
    assert same_ == 1.0 and abs(half - 0.5) < 0.3 and none < 0.3


def test_likeness_of_repeats_and_of_one_sentence(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = {"many": "again and again. " * 40_000, "less": "again and again. " * 30_000, "one": " ".join(words), "edited": " ".join(words[:300] + [f"x{k}" for k in range(100)])}
    v = {r["id"]: r["vector"] for r in M.vectors(spark.createDataFrame(list(texts.items()), "id string, text string"), ["id"]).collect()}
    row = spark.createDataFrame([(v["many"], v["less"], v["one"], v["edited"])], "a array<long>, b array<long>, c array<long>, d array<long>")
    often, most, none = row.select(M.likeness(F.col("a"), F.col("b")), M.likeness(F.col("c"), F.col("d")), M.likeness(F.col("a"), F.col("c"))).first()
    assert often > 0.9 and abs(most - 0.75) < 0.2 and none < 0.3


def test_main_path_has_no_python(small):
    plan = M.edited_fingerprints(small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
