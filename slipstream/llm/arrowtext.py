"""Whole batches of texts as numpy arrays: runs of like bytes, their hashes, and helpers for Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: The white space that ends a word: space and U+0009 to U+000D. ``bytes.split()`` splits at the same six.
SPACES = b" \t\n\x0b\x0c\r"

SLICE_BYTES = 2 << 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_ONE = np.uint64(1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds at most ``most`` bytes of text or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, and where each begins (one more at the end). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or not len(offsets):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def raw_texts(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b if b is not None else b"" for b in texts.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the longest runs of one class within a text, and the number of runs before each text.

    ``classes`` gives each byte a class; class 0 separates and makes no run.
    """
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    kinds = classes[data]
    edge = np.empty(len(data) + 1, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:-1])
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = kinds[starts] != 0
    starts, ends = starts[real], ends[real]
    return starts, ends, np.searchsorted(starts, offsets)


class _Powers:
    """Powers of an odd base modulo 2^64 and their inverses, kept and lengthened as needed."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 2)
            both = []
            for factor in (self.base, self.inverse):
                steps = np.full(size, factor)
                steps[0] = _ONE
                both.append(np.cumprod(steps))
            if n > 8 * SLICE_BYTES:
                return both[0][:n], both[1][:n]
            self.up, self.down = both
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in _BASES]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each span, from one running sum of powers modulo 2^64."""
    up, down = _POWERS[lane].to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + _ONE) * up[: len(values)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts]
    return mix(found + (ends - starts).astype(np.uint64) * _BASES[1 - lane])


def appended(df: DataFrame, text: str, name: str, kind: str, made: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """``df`` with one more column ``name`` of type ``kind``, computed from ``text`` in Arrow batches.

    ``made`` runs once per task and returns the function of a batch; all other columns pass through.
    """
    place = df.columns.index(text)
    field = StructType.fromDDL(f"{name} {kind}").fields[0]
    schema = StructType([*df.schema.fields, field])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = made()
        for batch in slices(batches, place):
            yield pa.RecordBatch.from_arrays([*batch.columns, of(batch.column(place))], names=[*batch.schema.names, name])

    return df.mapInArrow(work, schema)
