"""Token ids in shard files that are wavelet matrices.

A shard holds the ids of up to 2^``shard_bits`` consecutive document ids, in ascending order, as one row of one
zstd-compressed Parquet file. The ids of a shard are renamed by descending frequency, so that only as many bit planes are
needed as its vocabulary asks for and the upper ones compress well. Plane by plane, from the highest bit, all zeros move
before all ones; with the number of ones before each block of 512 bits, every plane answers rank and select, and the
matrix answers access, counting and the place of the k-th occurrence without being unpacked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import subword
from slipstream.llm.arrowtext import slices
from slipstream.llm.ordering import sort_id, sum_before

BLOCK = 512
#: Tokens after which a shard goes on in a further part, so that a task's memory is bounded.
MOST_TOKENS = 1 << 24
#: Text that is encoded together.
SLICE_BYTES = 32 << 20
_SHARD = "shard long, part int, n long, width int, alphabet binary, planes binary, ranks binary, zeros array<long>, doc_ids array<long>, ends array<long>"


class Plane:
    """A bit vector with rank and select over its packed bytes."""

    def __init__(self, packed: np.ndarray, ranks: np.ndarray, n: int) -> None:
        self.packed, self.ranks, self.n = packed, ranks, n

    def bit(self, at: np.ndarray) -> np.ndarray:
        return (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place, from the block's count and the bytes of the block before the place."""
        block = at // BLOCK
        found = self.ranks[block].astype(np.int64)
        first, last = block * (BLOCK // 8), at >> 3
        for k in range(BLOCK // 8):
            byte = first + k
            whole = byte < last
            found += np.where(whole, np.bitwise_count(self.packed[np.minimum(byte, len(self.packed) - 1)]), 0)
        rest = self.packed[np.minimum(last, len(self.packed) - 1)] & ((1 << (at & 7)) - 1).astype(np.uint8)
        return found + np.where(last < len(self.packed), np.bitwise_count(rest), 0)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the ``k``-th (from 0) one or zero, by bisection over ranks."""
        low, high = np.zeros_like(k), np.full_like(k, self.n)
        while (low < high).any():
            middle = (low + high) // 2
            before = self.rank1(middle + 1)
            if not one:
                before = middle + 1 - before
            enough = before > k
            high = np.where((low < high) & enough, middle, high)
            low = np.where((low < high) & ~enough, middle + 1, low)
        return low


class WaveletMatrix:
    """A sequence of symbols ``0 .. 2^width - 1`` in bit planes, the highest first."""

    def __init__(self, n: int, width: int, planes: bytes, ranks: bytes, zeros: list[int]) -> None:
        self.n, self.width, self.zeros = n, width, zeros
        packed = np.frombuffer(planes, np.uint8).reshape(max(width, 1), -1)
        counts = np.frombuffer(ranks, "<u4").reshape(max(width, 1), -1)
        self.planes = [Plane(packed[k], counts[k], n) for k in range(width)]

    @staticmethod
    def build(symbols: np.ndarray) -> WaveletMatrix:
        n = len(symbols)
        width = int(symbols.max()).bit_length() if n else 0
        now = pa.array(symbols.astype(np.uint16 if width <= 16 else np.uint32))
        planes, ranks, zeros = [], [], []
        for shift in range(width - 1, -1, -1):
            packed = np.packbits((now.to_numpy() & (1 << shift)) != 0, bitorder="little")
            words = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
            words[: len(packed)] = packed
            per_block = np.bitwise_count(words.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
            planes.append(packed.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<u4").tobytes())
            left, right = (pc.filter(now, pa.BooleanArray.from_buffers(pa.bool_(), n, [None, pa.py_buffer(bits)])) for bits in (~packed, packed))
            zeros.append(len(left))
            now = pa.concat_arrays([left, right])
        return WaveletMatrix(n, width, b"".join(planes), b"".join(ranks), zeros)

    def parts(self) -> tuple[bytes, bytes]:
        return b"".join(p.packed.tobytes() for p in self.planes), b"".join(p.ranks.tobytes() for p in self.planes)

    def symbols(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest."""
        now = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for shift, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            ones = np.unpackbits(plane.packed, count=self.n, bitorder="little").astype(bool)
            before = np.empty_like(now)
            before[~ones] = now[:zeros]
            before[ones] = now[zeros:] | now.dtype.type(1 << shift)
            now = before
        return now

    def access(self, at: np.ndarray) -> np.ndarray:
        at, found = at.astype(np.int64), np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            ones, bit = plane.rank1(at), plane.bit(at)
            found = found * 2 + bit
            at = np.where(bit == 1, zeros + ones, at - ones)
        return found

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """The places in the last plane's order of ``symbol`` among the first ``end`` symbols."""
        low, high = 0, end
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            ones = plane.rank1(np.array([low, high]))
            if symbol >> (self.width - 1 - k) & 1:
                low, high = zeros + int(ones[0]), zeros + int(ones[1])
            else:
                low, high = low - int(ones[0]), high - int(ones[1])
        return low, high

    def rank(self, symbol: int, end: int) -> int:
        """How often ``symbol`` is among the first ``end`` symbols."""
        if symbol >> self.width:
            return 0
        low, high = self._range(symbol, end)
        return high - low

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Places of the ``k``-th (from 0) occurrences of ``symbol``, which has to have as many."""
        at = self._range(symbol, self.n)[0] + k.astype(np.int64)
        for shift, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            one = bool(symbol >> shift & 1)
            at = plane.select(at - zeros if one else at, one)
        return at


class Shard:
    """One row of a shard file."""

    def __init__(self, row: dict) -> None:
        self.alphabet = np.frombuffer(row["alphabet"], "<u4")
        self.matrix = WaveletMatrix(row["n"], row["width"], row["planes"], row["ranks"], row["zeros"])
        self.doc_ids, self.ends = row["doc_ids"], np.array(row["ends"], np.int64)

    @staticmethod
    def packed(shard: int, part: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> dict:
        tokens = np.concatenate(ids)
        times = np.bincount(tokens)
        used = np.flatnonzero(times)
        alphabet = used[np.argsort(-times[used], kind="stable")]
        rename = np.zeros(len(times), np.uint32)
        rename[alphabet] = np.arange(len(alphabet))
        matrix = WaveletMatrix.build(rename[tokens])
        planes, ranks = matrix.parts()
        ends = np.cumsum([len(x) for x in ids]).tolist()
        return {
            "shard": shard, "part": part, "n": len(tokens), "width": matrix.width, "alphabet": alphabet.astype("<u4").tobytes(), "planes": planes, "ranks": ranks,
            "zeros": matrix.zeros, "doc_ids": doc_ids, "ends": ends,
        }

    def ids(self) -> np.ndarray:
        return self.alphabet[self.matrix.symbols()] if self.matrix.n else np.empty(0, "<u4")

    def places(self, token: int) -> np.ndarray:
        """Places of ``token`` in the shard, in order."""
        found = np.flatnonzero(self.alphabet == token)
        if not len(found):
            return np.empty(0, np.int64)
        symbol = int(found[0])
        return self.matrix.select(symbol, np.arange(self.matrix.rank(symbol, self.matrix.n)))

    def count(self, token: int) -> int:
        found = np.flatnonzero(self.alphabet == token)
        return self.matrix.rank(int(found[0]), self.matrix.n) if len(found) else 0


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def encoded(docs: DataFrame, vocabulary: str, end: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, sort_id, ids)``: ids of each whole text and ``end``, as little-endian unsigned integers of 16 bits where all fit
    in them, else of 32; the ids are those of the library's default call."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), sort_id(doc_id).alias("sort_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = subword.encoder(vocabulary)
        for batch in slices(batches, 2, SLICE_BYTES):
            ids = subword.with_end(encode(batch.column(2)), end)
            small = len(ids.values) == 0 or int(ids.values.max()) < 1 << 16
            raw, size = memoryview(ids.values.astype("<u2" if small else "<u4").tobytes()), 2 if small else 4
            ends = (size * ids.starts).tolist()
            rows = pa.array([bytes(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            sizes = pa.array(np.full(batch.num_rows, size), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sizes, rows], names=["doc_id", "sort_id", "size", "ids"])

    return own.mapInArrow(work, "doc_id long, sort_id long, size int, ids binary")


def write(docs: DataFrame, path: str, vocabulary: str, end: int = 0, shard_bits: int = 12, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes a file for each shard (and part) of ``docs`` to ``path``: ids of each whole text and the id ``end``.

    Texts are encoded where they are read; only ids are exchanged. Null and empty texts are the end id alone; a very long one
    is a part of its own. A null id sorts first. Rows with one id are each written. An empty table writes no shard. Other
    columns, whatever their names, are not read.
    """
    dealt = encoded(docs, vocabulary, end, doc_id, text).withColumn("shard", F.shiftright("sort_id", shard_bits))
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "sort_id", F.xxhash64("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, doc_ids, ids, held = None, 0, [], [], 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([Shard.packed(now, part, doc_ids, ids)], schema=schema)

        for batch in batches:
            for row_id, size, raw, shard in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if doc_ids and (shard != now or held >= MOST_TOKENS):
                    yield made()
                    part = part + 1 if shard == now else 0
                    doc_ids, ids, held = [], [], 0
                elif shard != now:
                    part = 0
                now = shard
                doc_ids.append(row_id)
                ids.append(np.frombuffer(raw, f"<u{size}"))
                held += len(ids[-1])
        if doc_ids:
            yield made()

    schema = pa.schema([
        ("shard", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("width", pa.int32()), ("alphabet", pa.binary()), ("planes", pa.binary()), ("ranks", pa.binary()),
        ("zeros", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
    ])
    shards = dealt.select("doc_id", "size", "ids", "shard").mapInArrow(work, _SHARD)
    shards.write.option("compression", "zstd").option("maxRecordsPerFile", 1).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The shard files in ``path``."""
    return spark.read.schema(_SHARD).parquet(path)


def starts(shards: DataFrame) -> DataFrame:
    """``(shard, part, base)``: ids in all shards before; only the lengths are read."""
    return sum_before(shards.select("shard", "part", "n"), "n", ["shard", "part"], "base").select("shard", "part", "base")


def documents(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, unpacked from the shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                shard = Shard(row)
                raw = memoryview(shard.ids().astype("<u4").tobytes())
                begin = np.concatenate([[0], shard.ends[:-1]])
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), shard.ends.tolist(), strict=True)]
                same = np.ones(len(crc), np.int64)
                columns = [pa.array(same * row["shard"]), pa.array((same * row["part"]).astype(np.int32)), pa.array(shard.doc_ids, pa.int64())]
                columns += [pa.array(begin.astype(np.int64)), pa.array(shard.ends - begin), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "part", "doc_id", "begin", "n_tokens", "ids_crc32"])

    found = shards.mapInArrow(work, "shard long, part int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    based = found.join(starts(shards), ["shard", "part"])
    return based.select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """``(doc_id, place)`` of every occurrence of ``token``, by select in each shard; nothing else is unpacked."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                shard = Shard(row)
                at = shard.places(token)
                doc = np.searchsorted(shard.ends, at, side="right")
                begin = np.concatenate([[0], shard.ends])[doc]
                ids = pa.array(shard.doc_ids, pa.int64()).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([ids, pa.array((at - begin).astype(np.int64))], names=["doc_id", "place"])

    return shards.mapInArrow(work, "doc_id long, place long")


def counted(shards: DataFrame, token: int) -> DataFrame:
    """``(shard, part, times)``: how often each shard has ``token``, by rank."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "part": row["part"], "times": Shard(row).count(token)}])

    return shards.mapInArrow(work, "shard long, part long, times long")
