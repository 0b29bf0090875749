"""Quality classifier by importance resampling.

Two hashed n-gram multinomials are fitted, of trusted target text and of the raw corpus. The mean log ratio of a
document's n-grams, over a temperature, is its log importance weight; adding Gumbel noise to the log weights and taking the
largest ``k`` draws ``k`` documents without replacement in proportion to their weights. The noise comes from a hash of the
row, so a lost task draws the same again.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm import ngram_ratio
from slipstream.llm.arrowtext import appended, free_name
from slipstream.llm.ngram_ratio import Model, Shape
from slipstream.llm.staging import staged

BINS, FEW = 4096, 50_000


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape(), most_labels: int = 20_000, lost: float = 0.002
) -> Model:
    """Raw counts over all documents; at most ``most_labels`` labelled rows (a bounded sample by hash)."""
    return ngram_ratio.fit(docs, labels, doc_id, text, shape, most_labels, lost)


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the mean log ratio of each whole text. A null or empty text has no n-gram and scores 0."""

    def made():
        return lambda texts: pa.array(model.scores(texts))

    return appended(docs, text, out, "double", made)


def gumbel(seed: int, *columns: Column) -> Column:
    """Gumbel noise that depends on ``columns`` alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)
    return -F.log(-F.log((bits + 0.5) / float(1 << 52)))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The ``k``-th largest value of ``keys(key)``, by histograms of ``BINS`` rows each, narrowed until few are left."""
    rest, wanted = keys.where("key is not null"), k
    while True:
        low, high, n = rest.agg(F.min("key"), F.max("key"), F.count("*")).first()
        if n == 0:
            return np.inf
        if low == high or wanted >= n:
            return low
        if n <= FEW:
            return sorted((r[0] for r in rest.collect()), reverse=True)[wanted - 1]
        place = F.least(F.floor((F.col("key") - low) / (high - low) * BINS), F.lit(BINS - 1))
        counts = dict(rest.groupBy(place.alias("bin")).count().collect())
        for at in sorted(counts, reverse=True):
            if wanted <= counts[at]:
                break
            wanted -= counts[at]
        rest = rest.where(place == at)


def _keyed(rows: DataFrame, temperature: float, seed: int, identity: Column, score: str) -> Column:
    return F.col(score) / temperature + gumbel(seed, identity)


def resampled(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", k: int | None = None, temperature: float = 0.001, seed: int = 7
) -> DataFrame:
    """``(doc_id, score, key, kept)`` for every row of ``docs``.

    ``k`` documents are drawn; unless it is given, as many as score at least the model's threshold. Rows with equal
    keys, such as repeated rows, are kept or dropped together. Empty and null texts score 0 and take part. A null id
    draws noise as any other value. An empty table gives an empty result.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = staged(scored(own, model, "text", "score").withColumn("key", _keyed(own, temperature, seed, F.col("doc_id"), "score")).drop("text"), "scores")
    return rows.withColumn("kept", F.col("key") >= _cut(rows, model, k))


def _cut(rows: DataFrame, model: Model, k: int | None) -> float:
    if k is None:
        k = rows.where(F.col("score") >= float(model.threshold)).count()
    return float(kth_largest(rows.select("key"), k)) if k > 0 else float("inf")


def kept_documents(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", k: int | None = None, temperature: float = 0.001, seed: int = 7
) -> DataFrame:
    """The rows of ``docs`` that ``resampled`` keeps, with all their columns as they were."""
    score = free_name(docs, "score")
    rows = scored(docs, model, text, score)
    key = _keyed(rows, temperature, seed, F.col(doc_id).cast("long"), score)
    keys = staged(rows.select(F.col(score).alias("score"), key.alias("key")), "scores")
    return rows.where(key >= _cut(keys, model, k)).drop(score)


def with_threshold(model: Model, threshold: float) -> Model:
    return replace(model, threshold=threshold)
