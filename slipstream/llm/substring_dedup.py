"""Repeated passages by recompression.

**Rounds.** Every word is a symbol. First, runs of up to three equal symbols become one symbol; then, in each round, a
symbol is left- or right-handed by a bit of its name and the round's number, and every left-handed symbol followed by a
right-handed one is replaced with a symbol for the pair, while the pair stays within the round's length. A symbol's name
is a 64-bit hash of the names it is made of, so all tasks of the Spark job give equal runs and pairs one name without
an exchange. Whether a cut between two symbols goes away depends on both neighbours only; by induction, cuts that are
``MARGIN`` words or more from both ends of a text stretch are the same wherever the stretch occurs.

**Anchors.** The inner part of each window of 50 words, ``MARGIN`` words from its ends, always holds a whole symbol. The
one with the least name is the window's anchor, so equal windows have equal anchors, and some eight neighbouring
windows share one. An anchor row carries the name of the anchor's surroundings (the symbol and ``MARGIN`` words on both
sides, which all its windows contain) and a name of everything its windows cover.

**Spark.** Surroundings found in one document only are dropped. Where everything an anchor's windows cover is
found in a smaller document, all of these windows are repeats; that settles the inside of long repeats with one row for
each anchor. Only the least document of each such class, and only where a surrounding has several classes (the ends of
repeats), is looked at window by window: those windows are named by 128 bits, and the least document of each name is
compared. All groups are combined before the shuffle and written before they are joined, so that both sides of a join are
plain exchanges and a passage that a third of all documents share is split; no window is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slipstream.llm.arrowtext import flat, free_name, mix, raw_texts, runs, slices, span_hashes
from slipstream.llm.staging import staged

WINDOW = 50
RUN = 3
#: Longest symbol in words after each round of pairs.
LENGTHS = (4, 6, 8)
#: A run is known within RUN + 1 words; each round adds the length of the symbols it starts from.
MARGIN = RUN + 1 + RUN + LENGTHS[0] + LENGTHS[1]
INNER = WINDOW - 2 * MARGIN
assert INNER >= 2 * LENGTHS[-1] - 1, "a window's inner part must hold a whole symbol"

_NOT_SPACE = np.ones(256, np.uint8)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return text.split()


def symbols(words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the last round's symbols, and the place of each one's first word (one more place at the end).

    ``words`` are word names, ``of`` the text of each word; a symbol never spans two texts.
    """
    n = len(words)
    if not n:
        return words, np.zeros(1, np.int64)
    fresh = np.ones(n, bool)
    fresh[1:] = (words[1:] != words[:-1]) | (of[1:] != of[:-1])
    run_at = np.flatnonzero(fresh)
    run_len = np.diff(np.append(run_at, n))
    keep = fresh | (np.repeat(run_len, run_len) > RUN)  # a longer run stays single words
    at = np.flatnonzero(keep)
    length = np.diff(np.append(at, n))
    names = np.where(length > 1, mix(words[at] + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), words[at])
    for number, most in enumerate(LENGTHS, 1):
        left = (mix(names + np.uint64(number) * np.uint64(0x9FB21C651E98DF25)) & np.uint64(1)) == 0
        length = np.diff(np.append(at, n))
        pair = left[:-1] & ~left[1:] & (length[:-1] + length[1:] <= most) & (of[at[:-1]] == of[at[1:]])
        first = np.flatnonzero(pair)
        names[first] = mix(mix(names[first] + np.uint64(number)) ^ (names[first + 1] * np.uint64(0x9E3779B97F4A7C15)))
        stay = np.ones(len(names), bool)
        stay[first + 1] = False
        names, at = names[stay], at[stay]
    return names, np.append(at, n)


def _least_in_range(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the first least value in each ``[low, high)``; every range has 1 to ``INNER`` values."""
    n = len(values)
    best = np.arange(n)
    tables = [best]
    step = 1
    while 2 * step <= INNER and 2 * step <= n:
        a, b = tables[-1][: n - 2 * step + 1], tables[-1][step : n - step + 1]
        tables.append(np.where(values[b] < values[a], b, a))
        step *= 2
    level = np.floor(np.log2(high - low)).astype(np.int64)
    place = np.empty(len(low), np.int64)
    for k, table in enumerate(tables):
        here = level == k
        a, b = table[low[here]], table[high[here] - (1 << k)]
        place[here] = np.where(values[b] < values[a], b, a)
    return place


def anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """For each anchor: its text, name of its surroundings, name of all its windows cover, first and last window."""
    starts, ends, first = runs(data, offsets, _NOT_SPACE)
    words = span_hashes(data, starts, ends)
    counts = np.diff(first)
    of = np.repeat(np.arange(len(counts)), counts)
    windows = np.arange(max(len(words) - WINDOW + 1, 0))
    windows = windows[of[windows] == of[windows + WINDOW - 1]] if len(windows) else windows
    if not len(windows):
        none = np.empty(0, np.int64)
        return {"of": none, "around": none, "whole": none, "low": none, "high": none}
    names, at = symbols(words, of)
    low = np.searchsorted(at[:-1], windows + MARGIN)
    high = np.searchsorted(at[1:], windows + WINDOW - MARGIN, side="right")
    anchor = _least_in_range(names, low, high)
    edge = np.ones(len(windows), bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(edge)
    w_low = windows[begin]
    w_high = windows[np.append(begin[1:], len(windows)) - 1]
    symbol = anchor[begin]
    text = of[w_low]
    return {
        "of": text,
        "around": span_hashes(words, at[symbol] - MARGIN, at[symbol + 1] + MARGIN).view(np.int64),
        "whole": span_hashes(words, w_low, w_high + WINDOW, lane=1).view(np.int64),
        "low": w_low - first[text],
        "high": w_high - first[text],
    }


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        found = anchors(*flat(batch.column(2)))
        of = pa.array(found["of"])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), batch.column(1).take(of), pa.array(found["around"]), pa.array(found["whole"]), pa.array(found["low"].astype(np.int32)), pa.array(found["high"].astype(np.int32))],
            names=["doc_id", "copy", "around", "whole", "low", "high"],
        )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window in the spans ``[low, high]`` of a document."""
    for batch in slices(batches, 2):
        data, offsets = flat(batch.column(2))
        starts, ends, first = runs(data, offsets, _NOT_SPACE)
        words = span_hashes(data, starts, ends)
        spans = batch.column(3)
        flat_spans = spans.flatten()
        low, high = (flat_spans.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        per_doc = pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(batch.num_rows), per_doc)
        n = high - low + 1
        row = np.repeat(np.arange(len(n)), n)
        place = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = first[of[row]] + place
        owner = pa.array(of[row])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(place.astype(np.int32)), *[pa.array(span_hashes(words, at, at + WINDOW, lane).view(np.int64)) for lane in (0, 1)]],
            names=["doc_id", "copy", "place", "h0", "h1"],
        )


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, copy, spans)``: spans ``(from, to)`` of words, in no order, covered by windows of a smaller document.

    ``copy`` is a hash of the text, so that rows with one id and different texts keep apart. Only documents with such
    spans have a row. Windows are judged on ``docs`` as they are. Rows with a null id or text neither repeat nor are
    repeated.
    """
    own = docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("copy"), F.col(text).alias("text")
    )
    rows = staged(own.mapInArrow(_anchor_rows, "doc_id long, copy long, around long, whole long, low int, high int"), "anchors")

    several = rows.groupBy("around").agg(F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"), F.min("whole").alias("w0"), F.max("whole").alias("w1"))
    shared = staged(several.where("d0 < d1").select("around", (F.col("w0") < F.col("w1")).alias("many")), "shared")
    candidates = staged(rows.join(shared, "around"), "candidates")

    classes = staged(candidates.groupBy("around", "whole").agg(F.min("doc_id").alias("least")), "least")
    sided = staged(candidates.join(classes, ["around", "whole"]).select("doc_id", "copy", "low", "high", "many", "least"), "classes")
    inside = sided.where("doc_id > least").select("doc_id", "copy", F.col("low").alias("from"), (F.col("high") + WINDOW).alias("to"))

    open_spans = sided.where("doc_id = least and many").groupBy("doc_id", "copy").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    texts = own.join(open_spans, ["doc_id", "copy"]).select("doc_id", "copy", "text", "spans")
    windows = staged(texts.mapInArrow(_window_rows, "doc_id long, copy long, place int, h0 long, h1 long"), "windows")
    least = windows.groupBy("h0", "h1").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    ends = windows.join(staged(least.drop("most"), "least"), ["h0", "h1"]).where("doc_id > least")
    ends = ends.select("doc_id", "copy", F.col("place").alias("from"), (F.col("place") + WINDOW).alias("to"))

    spans = inside.unionByName(ends).groupBy("doc_id", "copy").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    return staged(spans, "spans")


def removed(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """``words`` without those in any span."""
    kept, at = [], 0
    for low, high in sorted(spans):
        if low > at:
            kept += words[at:low]
        at = max(at, high)
    return kept + words[at:]


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "dedup") -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, ``n_removed``, ``kept`` (the kept words joined by one space) and its SHA-256.

    A null or empty text has no words; a text of fewer than 50 words keeps all. Repeated rows of one document, and rows
    with a null id, lose nothing to each other. All columns of ``docs`` are returned as they were, one row per row.
    """
    spans = repeated_spans(docs, doc_id, text).withColumnsRenamed({"doc_id": "span_id", "copy": "span_copy", "spans": "span_list"})
    free = {c: free_name(docs, c) for c in spans.columns}
    spans = spans.withColumnsRenamed(free)
    match = (F.col(doc_id).cast("long") == F.col(free["span_id"])) & (F.xxhash64(F.col(text)) == F.col(free["span_copy"]))
    joined = docs.join(spans, match, "left").drop(free["span_id"], free["span_copy"])
    place, listed = docs.columns.index(text), len(docs.columns)
    kind = "struct<n_words: bigint, n_removed: bigint, kept: string, kept_sha256: string>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            n_words, n_removed, kept, digests = [], [], [], []
            for raw, found in zip(raw_texts(batch.column(place)), batch.column(listed).to_pylist(), strict=True):
                words = words_of(raw)
                left = removed(words, [(s["from"], s["to"]) for s in found]) if found else words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            made = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digests, pa.string())]
            found = pa.StructArray.from_arrays(made, names=["n_words", "n_removed", "kept", "kept_sha256"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:listed], found], names=[*batch.schema.names[:listed], out])

    return joined.mapInArrow(work, StructType([*docs.schema.fields, StructType.fromDDL(f"{out} {kind}").fields[0]]))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with each text that lost words replaced by the words it kept; others unchanged.

    A text of which nothing is left is empty. ``length``, if ``docs`` has such a column, is set to the new number of
    code points of a changed text.
    """
    out = free_name(docs, "dedup")
    rows = deduplicated(docs, doc_id, text, out)
    lost = F.col(f"{out}.n_removed") > 0
    changed = {text: F.when(lost, F.col(f"{out}.kept")).otherwise(F.col(text))}
    if length in docs.columns:
        changed[length] = F.when(lost, F.length(f"{out}.kept").cast(docs.schema[length].dataType)).otherwise(F.col(length))
    return rows.withColumns(changed).drop(out)
