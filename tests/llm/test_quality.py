import re
from collections import Counter

import numpy as np
import pytest

from slipstream.llm import ngram_ratio, quality_classifier, quality_rules
from tests.llm.conftest import pairs, words_of


def brute_measures(text):
    w = words_of(text)
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    times, cover = Counter(windows), set()
    for k, window in enumerate(windows):
        if times[window] > 1:
            cover |= set(range(k, k + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover)


@pytest.fixture(scope="module")
def model(small, labels):
    return quality_rules.fit(small, labels)


@pytest.mark.parametrize("which", ["odd", "small"])
def test_measures_and_verdicts(which, model, request):
    docs = request.getfixturevalue(which)
    out = quality_rules.judged(docs.select("doc_id", "text"), model).select("doc_id", "text", "rules.*").collect()
    assert len(out) == docs.count()
    for r in out:
        want = brute_measures(r["text"])
        assert tuple(r[m] for m in quality_rules.MEASURES) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= model.threshold)


def brute_features(text, shape):
    """N-grams as tuples, to be compared by how they repeat."""
    lowered = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[a-z0-9\x80-\U0010ffff]+|[^a-z0-9\x80-\U0010ffff\x20\x09-\x0D]+", lowered)
    return [tuple(tokens[k : k + n]) for n in range(1, shape.order + 1) for k in range(len(tokens) - n + 1)]


def test_features_are_the_token_n_grams(odd):
    import pyarrow as pa

    shape = ngram_ratio.Shape(buckets=1 << 60)
    texts = [t for _, t in pairs(odd)]
    found, owner = ngram_ratio.features(pa.array(texts, pa.string()), shape)
    names = {}
    for k, text in enumerate(texts):
        want = Counter(brute_features(text, shape))
        got = Counter(found[owner == k].tolist())
        assert sorted(want.values()) == sorted(got.values())
        for gram in want:
            names.setdefault(gram, set())
    assert len(set(found.tolist())) == len(names)


def test_ratio_is_that_of_the_counts(small, labels):
    import pyarrow as pa

    shape = ngram_ratio.Shape(buckets=1 << 12, order=1, prior=2.0)
    model = ngram_ratio.fit(small, labels, "doc_id", "text", shape, 10_000, 0.01)
    good = {r["label_id"] for r in ngram_ratio.labelled(labels, 10_000).where("good and part = 0").collect()}
    raw, trusted = np.zeros(1 << 12), np.zeros(1 << 12)
    for i, text in pairs(small):
        found, _ = ngram_ratio.features(pa.array([text], pa.string()), shape)
        raw += np.bincount(found, minlength=1 << 12)
        if i in good:
            trusted += np.bincount(found, minlength=1 << 12)
    want = np.log((trusted + 2.0) / (raw * trusted.sum() / raw.sum() + 2.0))
    assert np.allclose(model.ratio, want)


def test_held_out_accuracy(spark):
    """Trained on the labels of one half, clean documents stay and poor ones go; judged on labels it has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen, unseen = labels.where("doc_id % 2 = 0"), {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.where("doc_id % 2 = 1").collect()}
    for kept in (
        {r["doc_id"]: r["kept"] for r in quality_classifier.resampled(docs, quality_classifier.fit(docs, seen)).collect()},
        {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs, quality_rules.fit(docs, seen)).select("doc_id", "rules.*").where("not base_failed").collect()},
    ):
        clean = [kept[i] for i, v in unseen.items() if v == (1, 0) and i in kept]
        poor = [kept[i] for i, v in unseen.items() if v[0] == 0 and i in kept]
        assert np.mean(clean) >= 0.97
        assert np.mean(poor) <= 0.25


def test_kth_largest_is_exact(spark):
    rng = np.random.default_rng(1)
    values = [float(x) for x in rng.normal(size=3000)] + [1.5] * 500 + [-1e9]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    before, quality_classifier.FEW = quality_classifier.FEW, 20
    try:
        for k in (1, 2, 37, 900, 3500, 3501, 9999):
            assert quality_classifier.kth_largest(keys, k) == sorted(values, reverse=True)[min(k, len(values)) - 1]
    finally:
        quality_classifier.FEW = before


def test_draws_k_and_repeats_its_draw(small, labels):
    model = quality_classifier.fit(small, labels)
    first = quality_classifier.resampled(small, model, k=50, temperature=1.0)
    again = quality_classifier.resampled(small.repartition(7), model, k=50, temperature=1.0)
    kept = {r["doc_id"] for r in first.where("kept").collect()}
    assert len(kept) == 50 and kept == {r["doc_id"] for r in again.where("kept").collect()}
    other = {r["doc_id"] for r in quality_classifier.resampled(small, model, k=50, temperature=1.0, seed=8).where("kept").collect()}
    assert other != kept


def test_odd_rows_empty_tables_and_columns(odd, table, spark, labels):
    model = quality_classifier.fit(odd, labels)
    assert quality_classifier.resampled(odd, model).count() == odd.count()
    left = quality_classifier.kept_documents(odd, model)
    assert left.columns == odd.columns
    assert quality_rules.kept_documents(odd, model).columns == odd.columns
    nothing = labels.limit(0)
    for docs in (odd, table([])):
        blank = quality_rules.fit(docs, nothing)
        assert not blank.ratio.any() and blank.threshold == -np.inf
        assert quality_classifier.kept_documents(docs, blank).count() == docs.count()
        assert quality_rules.judged(docs.select("doc_id", "text"), blank).count() == docs.count()
    nulls = spark.createDataFrame([(None, 1, 0), (3, None, 0), (4, 1, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    assert [tuple(r)[:2] for r in ngram_ratio.labelled(nulls, 10).collect()] == [(4, False)]


def test_held_out_toxic_documents_go(spark):
    """Fluent documents with a few toxic words are dropped by each filter, judged on labels it has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen, unseen = labels.where("doc_id % 2 = 0"), {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.where("doc_id % 2 = 1").collect()}
    for kept in (
        {r["doc_id"]: r["kept"] for r in quality_classifier.resampled(docs, quality_classifier.fit(docs, seen)).collect()},
        {r["doc_id"]: r["kept"] for r in quality_rules.judged(docs, quality_rules.fit(docs, seen)).select("doc_id", "rules.*").where("not base_failed").collect()},
    ):
        clean = [kept[i] for i, v in unseen.items() if v == (1, 0) and i in kept]
        toxic = [kept[i] for i, v in unseen.items() if v == (1, 1) and i in kept]
        assert np.mean(clean) >= 0.99
        assert np.mean(toxic) <= 0.3
