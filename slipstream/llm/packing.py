"""Best-fit packing by minimum bin slack.

A bin takes the longest piece left and, from a subset-sum table over the lengths that are available, the combination that
leaves the least of the bin empty; the table is a bitset, one shift and one ``or`` for each choice. What was packed is removed
and the next bin follows. Only the number of pieces of each length matters for that, so the plan is made from a histogram of
at most ``capacity`` rows, and a combination is used as often as the histogram allows at once. Spark then numbers the pieces
of each length, in blocks, and every piece finds its place in the plan by its number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slipstream.llm import subword
from slipstream.llm.arrowtext import slices
from slipstream.llm.staging import staged

CAPACITY = 1024
END = 2
BLOCKS = 1024
#: Text that is encoded together.
SLICE_BYTES = 4 << 20


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length of ``counts`` fill ``room`` best."""
    reach, steps, full = 1, [], 1 << room
    within = (full << 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, many = min(counts[length], room // length), 1
        while left and not reach & full:
            many = min(many, left)
            steps.append((length, many, reach))
            reach |= reach << length * many & within
            left -= many
            many *= 2
        if reach & full:
            break
    target, chosen = reach.bit_length() - 1, {}
    for length, many, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] = chosen.get(length, 0) + many
            target -= length * many
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, combination)`` pairs that together use every piece of the histogram ``counts`` once."""
    left, found = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        combination = fullest({x: n for x, n in rest.items() if n}, capacity - longest)
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[x] // n for x, n in combination.items())
        found.append((times, combination))
        for x, n in combination.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return found


class _Places:
    """Where the piece of a length and number goes, from the plan's runs of numbers."""

    def __init__(self, found: list[tuple[int, dict[int, int]]]) -> None:
        used, sequence, rows = {}, 0, []
        for times, combination in found:
            offset = 0
            for length, n in combination.items():
                begin = used.get(length, 0)
                rows.append((length, begin, sequence, n, offset))
                used[length] = begin + times * n
                offset += length * n
            sequence += times
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.length, self.begin, self.sequence, self.per_bin, self.offset = table.T
        self.key = (self.length << 48) + self.begin

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 48) + number, side="right") - 1
        within, n = number - self.begin[at], self.per_bin[at]
        return self.sequence[at] + within // n, self.offset[at] + within % n * length


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of the token ids of each whole text with ``end`` after them.

    Pieces are whole ones, after a shorter first one where the length leaves a rest. The ids are those of the library's
    default call, so the string of a special token in a text is its id.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    last = np.array([end], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subword.encoder(path)
        for batch in slices(batches, 1, SLICE_BYTES):
            ids = subword.with_end(encode(batch.column(1)), end)
            tokens = np.diff(ids.starts)
            many = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), many)
            place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            rest = (tokens % capacity)[row]
            start = np.where((rest > 0) & (place > 0), rest + (place - 1) * capacity, place * capacity)
            length = np.where((rest > 0) & (place == 0), rest, capacity)
            begin, raw = (4 * (ids.starts[row] + start)).tolist(), memoryview(ids.values.tobytes())
            crc = [zlib.crc32(raw[at : at + n]) for at, n in zip(begin, (4 * length).tolist(), strict=True)]
            columns = [pa.array(place, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return own.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def numbered(found: DataFrame) -> DataFrame:
    """Numbers the pieces of each length from 0, in ``BLOCKS`` blocks by hash, so a frequent length is spread."""
    blocked = found.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BLOCKS)))
    sizes = blocked.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")
    starts = sizes.select("length", "block", before.alias("before"))
    own = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = blocked.withColumn("own", F.row_number().over(own) - 1)
    return ranked.join(starts, ["length", "block"]).withColumn("number", F.col("before") + F.col("own")).drop("block", "own", "before")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its ``sequence_id`` (from 0) and ``offset``; sequences have no gaps and at most ``capacity`` tokens.

    Null and empty texts are the end token alone; a very long one is encoded in one task and cut. Repeated rows are packed
    each. A null id is carried along. An empty table gives an empty result. Other columns, whatever their names, are not read.
    """
    found = staged(pieces(docs, path, capacity, end, doc_id, text), "pieces")
    counts = dict(found.groupBy("length").count().collect())
    places = _Places(plan(counts, capacity))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places(*(batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "number")))
            columns = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered(found).mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
