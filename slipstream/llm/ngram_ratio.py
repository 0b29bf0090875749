"""Two multinomials over hashed n-grams, one of trusted text and one of the raw corpus, and their log ratio.

Tokens are runs of letters, digits and bytes from 0x80 on (A-Z lower-cased), and runs of other visible ASCII. Token
n-grams up to ``order`` fall into ``buckets`` by hash. The raw counts are scaled to the size of the trusted ones and both
get the same ``prior`` per bucket, so both are distributions and a rare n-gram says little.

A mean hardly moves by a few words, so toxic documents have a statistic of their own: how much more often labelled toxic
documents have a token than trusted ones, where that is no chance, summed over the ``WORST`` tokens of a text. A document over its cut scores below
the threshold whatever its mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import flat, mix, runs, slices, span_hashes

#: Tokens that make up the harm of a text; documents added to each bucket; standard deviations from which a share is no chance.
WORST, HARM_PRIOR, SURE = 3, 1.0, 4.0

_WORD, _MARK = 1, 2
_CLASSES = np.full(256, _MARK, np.uint8)
_CLASSES[0x80:] = _WORD
_CLASSES[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _WORD
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass(frozen=True)
class Shape:
    """``buckets`` is a power of two; ``order`` the longest n-gram; ``prior`` the count added to each bucket."""

    buckets: int = 1 << 16
    order: int = 2
    prior: float = 8.0


def features(texts: pa.Array, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram of each text, and the text it is of, in ascending order."""
    data, offsets = flat(texts)
    data = _LOWER[data]
    starts, ends, first = runs(data, offsets, _CLASSES)
    words = span_hashes(data, starts, ends)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    shift = np.uint64(64 - (shape.buckets.bit_length() - 1))
    found, owner, chain = [words >> shift], [of], words
    for n in range(2, shape.order + 1):
        chain = mix(chain[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[n - 1 :]) if len(chain) else chain
        inside = of[: len(chain)] == of[n - 1 :]
        found.append(chain[inside] >> shift)
        owner.append(of[: len(chain)][inside])
    return np.concatenate(found).astype(np.int64), np.concatenate(owner)


def labelled(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows ``(label_id, good, toxic, part)`` of ``labels(doc_id, quality, toxic)``, chosen by a hash of the id.

    Good is quality 1 and not toxic. ``part`` 0 fits the models, ``part`` 1 sets the threshold. An id with several
    labels is good only if all are, and toxic if one is; a null in id or quality drops the label, a null in toxic is not
    toxic.
    """
    rows = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    each = rows.agg(F.min(F.expr("quality = 1 and coalesce(toxic, 0) = 0")).alias("good"), F.max(F.expr("coalesce(toxic, 0) <> 0")).alias("toxic"))
    order = F.xxhash64(F.col("label_id"), F.lit("labelled"))
    return each.withColumn("part", F.pmod(F.xxhash64(F.col("label_id"), F.lit("part")), F.lit(2)).cast("int")).orderBy(order, "label_id").limit(most)


@dataclass(frozen=True)
class Model:
    """Log ratio by bucket, natural logarithm, and the score from which a document counts as trusted; log ratio of toxic
    documents to trusted ones by bucket of a token, and the harm up to which a document scores its mean."""

    shape: Shape
    ratio: np.ndarray
    threshold: float
    harm: np.ndarray
    most_harm: float = np.inf

    def means(self, texts: pa.Array) -> np.ndarray:
        """Mean log ratio over the n-grams of each text; 0 where there is none."""
        found, owner = features(texts, self.shape)
        n = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, weights=self.ratio[found], minlength=len(texts))
        return total / np.maximum(n, 1)

    def harms(self, texts: pa.Array) -> np.ndarray:
        """Sum of the ``WORST`` highest log ratios above 0 over the different tokens of each text."""
        bucket, owner = _presence(texts, self.shape, self.harm > 0)
        value = self.harm[bucket]
        bad = np.lexsort((-value, owner))
        rank = np.arange(len(bad)) - np.searchsorted(owner[bad], owner[bad])
        worst = bad[rank < WORST]
        return np.bincount(owner[worst], weights=value[worst], minlength=len(texts)).astype(float)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The mean of each text; of one with too much harm, that or the threshold, whichever is less, less the harm."""
        means, harms = self.means(texts), self.harms(texts)
        return np.where(harms > self.most_harm, np.minimum(means, self.threshold) - harms, means)


def _presence(texts: pa.Array, shape: Shape, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets, ``among`` those marked, of the single tokens of each text, and its place, in ascending order."""
    found, owner = features(texts, replace(shape, order=1))
    both = owner * shape.buckets + found
    both = np.unique(both if among is None else both[among[found]])
    return both % shape.buckets, both // shape.buckets


def _counted(shape: Shape):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted, clean, toxic = (np.zeros(shape.buckets, np.int64) for _ in range(4))
        for batch in slices(batches, 0):
            found, owner = features(batch.column(0), shape)
            good, bad = (batch.column(k).fill_null(False).to_numpy(zero_copy_only=False) for k in (1, 2))
            raw += np.bincount(found, minlength=shape.buckets)
            trusted += np.bincount(found[good[owner]], minlength=shape.buckets)
            either = good | bad
            if either.any():
                bucket, text = _presence(batch.column(0).filter(pa.array(either)), shape)
                for total, which in ((clean, good), (toxic, bad)):
                    total += np.bincount(bucket[which[either][text]], minlength=shape.buckets)
        some = np.flatnonzero(raw)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, raw[some], trusted[some], clean[some], toxic[some])], names=["bucket", *_COUNTS])

    return work


_COUNTS = ("raw", "trusted", "clean", "toxic")


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, shape: Shape, most_labels: int, lost: float
) -> Model:
    """Counts the raw multinomial over all of ``docs``, and the trusted one over the labelled documents of part 0.

    Labels are a bounded sample of ``most_labels`` rows, which proves the size of what is broadcast; every task adds up
    its buckets, so what is shuffled and collected is bounded by ``shape.buckets``. Both cuts are set on part 1, each with
    the best balanced accuracy: the threshold between good documents and those that are not toxic and not good, at most
    the quantile ``lost`` of good documents; the most harm between good and toxic ones, at least the quantile
    1 - ``lost`` of good ones. Without good documents the ratio is 0 everywhere; without labels in part 1 the
    threshold is below every document. Without good or toxic documents in either part no harm is too much.
    """
    sample = F.broadcast(labelled(labels, most_labels))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = own.join(sample, own.doc_id == F.col("label_id"), "left")
    counted = known.select("text", F.expr("good and part = 0").alias("good"), F.expr("toxic and part = 0").alias("toxic"))
    rows = counted.mapInArrow(_counted(shape), ", ".join(f"{c} long" for c in ("bucket", *_COUNTS)))
    table = rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in _COUNTS]).toPandas()
    raw, trusted, clean, toxic = (np.zeros(shape.buckets) for _ in _COUNTS)
    for c, total in zip(_COUNTS, (raw, trusted, clean, toxic), strict=True):
        total[table["bucket"]] = table[c]
    scaled = raw * (trusted.sum() / max(raw.sum(), 1.0))
    ratio = np.log((trusted + shape.prior) / (scaled + shape.prior))
    parts = known.where("part = 0").agg(F.count_if("good"), F.count_if("toxic")).first()
    harm = _harm(clean, toxic, *parts) if all(parts) else np.zeros(shape.buckets)
    model = Model(shape, ratio, -np.inf, harm)
    held = own.join(sample.where("part = 1"), own.doc_id == F.col("label_id")).select("text", "good", "toxic")
    found = held.mapInArrow(_scored(model), "score double, harm double, good boolean, toxic boolean").toPandas()
    good, bad = found["good"].to_numpy(bool), found["toxic"].to_numpy(bool)
    cut = threshold(found["score"].to_numpy(float)[~bad], good[~bad], lost)
    most = np.inf
    if all(parts) and good.any() and bad.any():
        most = -threshold(-found["harm"].to_numpy(float)[good | bad], good[good | bad], lost)
    return Model(shape, ratio, cut, harm, most)


def _harm(clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """Log ratio of the shares of toxic and clean documents that have a bucket; 0 where they may differ by chance."""
    ratio = np.log((toxic + HARM_PRIOR) / (n_toxic + 2 * HARM_PRIOR)) - np.log((clean + HARM_PRIOR) / (n_clean + 2 * HARM_PRIOR))
    deviation = np.sqrt((toxic + clean + 1) / (n_toxic + n_clean) / n_toxic)
    return np.where(toxic / n_toxic - clean / n_clean > SURE * deviation, ratio, 0.0)


def _scored(model: Model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            text = batch.column(0)
            columns = [pa.array(model.means(text)), pa.array(model.harms(text)), batch.column(1), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["score", "harm", "good", "toxic"])

    return work


def threshold(scores: np.ndarray, good: np.ndarray, lost: float) -> float:
    """The score with the best balanced accuracy, no higher than the quantile ``lost`` of the good ones."""
    if not good.any():
        return -np.inf
    most = float(np.quantile(scores[good], lost))
    if good.all():
        return most
    order = np.argsort(scores, kind="stable")
    below_good = np.concatenate([[0], np.cumsum(good[order])]) / good.sum()
    below_bad = np.concatenate([[0], np.cumsum(~good[order])]) / (~good).sum()
    best = int(np.argmax(below_bad - below_good))
    cut = -np.inf if best == 0 else scores[order[best - 1]]
    over = scores[order[best]] if best < len(scores) else cut
    return min(most, (cut + over) / 2 if np.isfinite(cut) else over)
