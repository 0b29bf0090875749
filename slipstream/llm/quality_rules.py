"""Quality rules: counts of each text, and a length-normalised log-likelihood ratio with one threshold for all documents.

The ratio is between two hashed n-gram multinomials, of trusted text and of the raw corpus; a document's mean over its
n-grams is compared with a threshold that is set once on held-out labels, so the verdict of a document depends on its text
and the model alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import ngram_ratio
from slipstream.llm.arrowtext import appended, flat, free_name, raw_texts, runs, span_hashes
from slipstream.llm.ngram_ratio import Model, Shape

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
_NOT_SPACE = np.ones(256, np.uint8)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
_IS_SYMBOL = np.zeros(256, np.uint8)
_IS_SYMBOL[list(SYMBOLS)] = 1
_STARTS_CHAR = (np.arange(256) & 0xC0) != 0x80

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape(order=1), most_labels: int = 20_000, lost: float = 0.002
) -> Model:
    """Raw counts over all documents; at most ``most_labels`` labelled rows (a bounded sample by hash)."""
    return ngram_ratio.fit(docs, labels, doc_id, text, shape, most_labels, lost)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeat_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words that a window of ``WINDOW`` words covers which the same text has twice or more."""
    n, counts = len(starts), np.diff(first)
    if n < WINDOW:
        return np.zeros(len(counts), np.int64)
    words = span_hashes(data, starts, ends)
    of = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(n - WINDOW + 1)
    at = at[of[at] == of[at + WINDOW - 1]]
    window = span_hashes(words, at, at + WINDOW) + of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, inverse, times = np.unique(window, return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    cover = np.zeros(n + 1, np.int32)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return _per_text(np.cumsum(cover[:n]) > 0, first)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measures(texts: pa.Array) -> list[pa.Array]:
    """The columns ``MEASURES`` of a batch."""
    data, offsets = flat(texts)
    starts, ends, first = runs(data, offsets, _NOT_SPACE)
    found = [
        np.diff(first),
        _per_text(_STARTS_CHAR[data] & (_NOT_SPACE[data] > 0), offsets),
        _per_text(_IS_SYMBOL[data], offsets),
        np.array([_dup_lines(t) for t in raw_texts(texts)], np.int64),
        _repeat_words(data, starts, ends, first),
    ]
    return [pa.array(x.astype(np.int64)) for x in found]


def judged(docs: DataFrame, model: Model, text: str = "text", out: str = "rules") -> DataFrame:
    """``docs`` with a struct ``out``: the measures, ``base_failed``, ``llr`` (mean log ratio) and ``kept``.

    A null text has no words, so it fails the base rules, as does an empty one. Repeated rows get equal verdicts. Every
    text is judged whole. An input column named ``out`` is an error, so choose a free name.
    """
    measured = ", ".join(f"{m}: bigint" for m in MEASURES)

    def made():
        def of(texts: pa.Array) -> pa.Array:
            return pa.StructArray.from_arrays([*measures(texts), pa.array(model.scores(texts))], names=[*MEASURES, "llr"])

        return of

    rows = appended(docs, text, out, f"struct<{measured}, llr: double>", made)
    failed = (F.col(f"{out}.n_words") < 20) | (100 * F.col(f"{out}.n_repeat_words") > 30 * F.col(f"{out}.n_words"))
    kept = ~failed & (F.col(f"{out}.llr") >= float(model.threshold))
    return rows.withColumn(out, F.struct(*[F.col(f"{out}.{m}").alias(m) for m in (*MEASURES, "llr")], failed.alias("base_failed"), kept.alias("kept")))


def kept_documents(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns as they were."""
    out = free_name(docs, "rules")
    return judged(docs, model, text, out).where(F.col(f"{out}.kept")).drop(out)
