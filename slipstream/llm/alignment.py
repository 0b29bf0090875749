"""Alignment of the tokens of two tokenizers, and how often their tokens end together in the corpus.

Byte offsets at which a token of either tokenizer ends cut both sequences into groups. A text is cut at lone spaces before
words, where both tokenizers begin a token, and each distinct chunk of a slice of texts is aligned once, in numpy over its
token ends.

The token of tokenizer A has at most one token of B with the same bytes: that map is an array made once. A group that is one
token and its image under the map needs no pair: it is counted in a vector over A's ids, one for each task. Only the last
tokens of irregular groups enter the shuffle, as pairs with their numbers. The second pass looks the counts up: the vector and
the best count of each B id are bounded by the vocabularies, the ``MOST`` most frequent pairs are broadcast, and pairs beyond
these meet the whole table in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm import subword
from slipstream.llm.arrowtext import slices
from slipstream.llm.staging import staged
from slipstream.llm.subword import Generations, Ragged, byte_letters, process_wide

PIECES = "piece_bpe_32k.model"
#: Irregular pairs that are broadcast for speed; all others are looked up by a join.
MOST = 1 << 18
SLICE_BYTES = 4 << 20
CACHE = 300_000
#: How a piece vocabulary spells a space.
SPACE = "▁"
_BAD = np.array([0xFFFFFFFF], "<u4").tobytes()


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: of ``<0xHH>`` the byte, of all others UTF-8 with spaces for U+2581."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(SPACE, " ").encode()


def identity(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each token of ``a`` the token of ``b`` with the same bytes, or -1; of several the last one."""
    place = {token: k for k, token in enumerate(b)}
    return np.array([place.get(token, -1) for token in a], np.int64)


class Aligned(NamedTuple):
    """Distinct chunks: tokens and groups of each, links of each with group's last tokens, and the groups spelled."""

    n_a: np.ndarray
    n_b: np.ndarray
    links: Ragged
    spelled: list[bytes]
    bad: np.ndarray


class Aligner:
    """Both tokenizers, and what a worker has learned of chunks."""

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = subword.encoder(path_a, specials=False)
        self.b = SentencePieceProcessor(model_file=path_b)
        vocabulary = Tokenizer.from_file(path_a).get_vocab()
        byte_of = {c: b for b, c in byte_letters().items()}
        self.bytes_a = [b""] * (1 + max(vocabulary.values()))
        for token, k in vocabulary.items():
            self.bytes_a[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece reaches over the beginning of a word")
        self.bytes_b = [b"" if self.b.is_control(k) or self.b.is_unknown(k) else piece_bytes(p) for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.same = identity(self.bytes_a, self.bytes_b)
        self.known = Generations(CACHE)
        most = max(len(self.bytes_a), len(self.bytes_b))
        digits = len(str(most - 1))
        numbers = np.arange(most)[:, None] // 10 ** np.arange(digits - 1, -1, -1)
        self.decimal = np.where((numbers > 0) | (np.arange(digits) == digits - 1), numbers % 10 + 48, 0).astype(np.uint8)

    def _encode_b(self, chunks: list[str]) -> list[bytes]:
        """Ids by tokenizer B of chunks that begin with the space B adds itself; one impossible id where bytes differ."""
        of = self.bytes_b.__getitem__
        found = self.b.encode([c[1:] for c in chunks], num_threads=1)
        return [np.array(ids, "<u4").tobytes() if b"".join(map(of, ids)) == c.encode() else _BAD for c, ids in zip(chunks, found, strict=True)]

    def distinct(self, cut: subword.Divided) -> Aligned:
        """Aligns the distinct chunks. A chunk whose bytes are not those of its tokens is bad and has none."""
        a = self.a.of_distinct(cut)
        # the head of a text that begins with its first word is empty
        raw = [b"" if not h else r for h, r in zip(cut.heads, self._encode_b(cut.heads), strict=True)]
        raw += self.known.of([f" {w}" for w in cut.bodies], self._encode_b)
        b = Ragged.of_bytes(raw)
        n_b = np.diff(b.starts)
        bad = np.zeros(len(raw), bool)
        bad[np.flatnonzero(n_b == 1)] = b.values[b.starts[:-1][n_b == 1]] == 0xFFFFFFFF
        n_a, n_b = np.where(bad, 0, np.diff(a.starts)), np.where(bad, 0, n_b)
        ids_a, ids_b = a.values[np.repeat(~bad, np.diff(a.starts))], b.values[np.repeat(~bad, np.diff(b.starts))]
        end_a, end_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends = np.zeros((2, 1 + (int(end_a[-1]) if len(end_a) else 0)), bool)
        ends[0, end_a], ends[1, end_b] = True, True
        last_a, last_b = ends[1, end_a], ends[0, end_b]  # tokens that end a group
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        links = ids_a[at_a].astype(np.int64) << 32 | ids_b[at_b]
        of_a = np.repeat(np.arange(len(bad)), n_a)
        starts = np.concatenate([[0], np.cumsum(np.bincount(of_a[at_a], minlength=len(bad)))]).astype(np.int64)
        # each group spelled: its A ids, then its B ids
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        place_a = np.arange(len(ids_a)) + np.concatenate([[0], at_b + 1])[group_a] if len(ids_a) else np.empty(0, np.int64)
        place_b = np.arange(len(ids_b)) + (at_a + 1)[group_b] if len(ids_b) else np.empty(0, np.int64)
        order[place_a], order[place_b] = np.arange(len(ids_a)), len(ids_a) + np.arange(len(ids_b))
        mark = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))]).astype(np.uint8)
        letters = np.concatenate([self.decimal[np.concatenate([ids_a, ids_b])], mark[:, None]], axis=1)[order]
        shown = letters != 0
        spelled = letters[shown].tobytes()
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])
        cuts = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])[tokens].tolist()
        return Aligned(n_a, n_b, Ragged(links, starts), [spelled[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)], bad)


_ROW = "kind int, doc_id long, row long, n_a long, n_b long, n_groups long, groups_sha256 string, ids array<int>, times array<long>, pairs array<long>, n array<long>"
_TEXT, _VECTOR, _PAIRS = range(3)


def _grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their weights."""
    if not len(keys):
        return keys.astype(np.int64), weights.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights, first)


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values, kind))


def _aligned_rows(path_a: str, path_b: str):
    """A row for each text, with its links; vectors and pairs of the task's texts."""

    def single(kind: int, **columns: pa.Array) -> dict:
        return {"kind": pa.array([kind], pa.int32())} | columns

    def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
        rows = len(columns["kind"])
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        schema = pa.schema([
            ("kind", pa.int32()), *[(c, pa.int64()) for c in ("doc_id", "row", "n_a", "n_b", "n_groups")], ("groups_sha256", pa.string()),
            ("ids", ints), ("times", longs), ("pairs", longs), ("n", longs),
        ])
        aligner = process_wide(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        vector, number = np.zeros(len(aligner.bytes_a), np.int64), TaskContext.get().partitionId() << 32
        for batch in slices(batches, 1, SLICE_BYTES):
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            cut = subword.divided(pa.array([f" {t}" if t else "" for t in subword.strings_of(texts)], pa.large_string()), places=subword.LONE_CUT)
            found = aligner.distinct(cut)
            of = np.repeat(np.arange(batch.num_rows), np.diff(cut.starts))
            sound = np.bincount(of[found.bad[cut.codes]], minlength=batch.num_rows) == 0
            here = sound[of]
            sums = [np.bincount(of[here], x[cut.codes[here]], batch.num_rows).astype(np.int64) for x in (found.n_a, found.n_b, np.diff(found.links.starts))]
            codes, ends, digests = cut.codes.tolist(), cut.starts.tolist(), []
            for k in range(batch.num_rows):
                whole = b"".join(map(found.spelled.__getitem__, codes[ends[k] : ends[k + 1]])) if sound[k] else b""
                digests.append(hashlib.sha256(whole[:-1]).hexdigest() if whole else "")
            dealt = found.links.dealt(cut.codes[here])
            links, row = dealt.values, np.repeat(of[here], np.diff(dealt.starts))
            regular = aligner.same[links >> 32] == (links & 0xFFFFFFFF)
            vector += np.bincount(links[regular] >> 32, minlength=len(vector))
            irregular, irregular_row = links[~regular], row[~regular]
            pairs, n = _grouped(irregular, np.ones(len(irregular), np.int64))
            width = len(vector)
            keys, times = _grouped(row[regular] * width + (links[regular] >> 32), np.ones(int(regular.sum()), np.int64))
            at = np.searchsorted(keys, np.arange(batch.num_rows + 1) * width)
            own = irregular_row * len(pairs) + np.searchsorted(pairs, irregular)
            own, own_n = _grouped(own, np.ones(len(own), np.int64))
            own_at = np.searchsorted(own, np.arange(batch.num_rows + 1) * len(pairs))
            rows = {
                "kind": pa.array(np.full(batch.num_rows, _TEXT), pa.int32()), "doc_id": batch.column(0), "row": pa.array(number + np.arange(batch.num_rows)),
                "n_a": pa.array(sums[0]), "n_b": pa.array(sums[1]), "n_groups": pa.array(sums[2]), "groups_sha256": pa.array(digests, pa.string()),
                "ids": _lists(keys % width, at, pa.int32()), "times": _lists(times, at, pa.int64()),
                "pairs": _lists(pairs[own % max(len(pairs), 1)], own_at, pa.int64()), "n": _lists(own_n, own_at, pa.int64()),
            }
            number += batch.num_rows
            yield batch_of(rows, schema)
            one = np.array([0, len(pairs)])
            yield batch_of(single(_PAIRS, pairs=_lists(pairs, one, pa.int64()), n=_lists(n, one, pa.int64())), schema)
        seen = np.flatnonzero(vector)
        one = np.array([0, len(seen)])
        yield batch_of(single(_VECTOR, ids=_lists(seen, one, pa.int32()), times=_lists(vector[seen], one, pa.int64())), schema)

    return work


def _counted_rows(sent: Broadcast):
    """Rows of texts with ``n_best`` and ``count_sum`` over the links that the broadcast counts settle, and the rest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regular, regular_best, known, counts, best = sent.value
        for batch in batches:
            flat = lambda c, b=batch: b.column(c).flatten().to_numpy(zero_copy_only=False)
            of = lambda c, b=batch: np.repeat(np.arange(b.num_rows), b.column(c).value_lengths().to_numpy(zero_copy_only=False))
            ids, times, row = flat("ids"), flat("times"), of("ids")
            total, most = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row, times * regular[ids])
            np.add.at(most, row, times * regular_best[ids])
            pairs, n, row = flat("pairs"), flat("n"), of("pairs")
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            there = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            np.add.at(total, row[there], n[there] * counts[at[there]])
            np.add.at(most, row[there], n[there] * best[at[there]])
            starts = np.concatenate([[0], np.cumsum(np.bincount(row[~there], minlength=batch.num_rows))])
            kept = [batch.column(c) for c in ("doc_id", "row", "n_a", "n_b", "n_groups", "groups_sha256")]
            made = [pa.array(most), pa.array(total), _lists(pairs[~there], starts, pa.int64()), _lists(n[~there], starts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=["doc_id", "row", "n_a", "n_b", "n_groups", "groups_sha256", "n_best", "count_sum", "pairs", "n"])

    return work


_COUNTED = "doc_id long, row long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, n array<long>"


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` with an ``n`` that at most ``most`` rows reach, from powers of two."""
    top = counts.agg(F.max("n")).first()[0] or 0
    steps = [1 << k for k in range(max(top, 1).bit_length() + 1)]
    row = counts.agg(*[F.count_if(F.col("n") >= s).alias(f"c{k}") for k, s in enumerate(steps)]).first()
    return counts.where(F.col("n") >= next(s for k, s in enumerate(steps) if row[k] <= most))


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs``.

    Tokenizer A, a byte-level vocabulary of the tokenizers library, reads a space and the text; tokenizer B, a piece model
    with byte fallback, the text. Null and empty texts, and those whose bytes are not those of the tokens, have no tokens:
    zeros and an empty digest. Repeated rows count each. A null id is carried along, a very long text is aligned in one task,
    an empty table gives an empty result. Other columns, whatever their names, are not read. ``most`` changes no result.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = staged(own.mapInArrow(_aligned_rows(path_a, path_b), _ROW), "aligned")
    entries = lambda kind, keys, numbers: rows.where(F.col("kind") == kind).select(F.explode(F.arrays_zip(keys, numbers)).alias("e"))
    regular = entries(_VECTOR, "ids", "times").groupBy(F.col("e.ids").alias("a")).agg(F.sum("e.times").alias("n"))
    pairs = staged(entries(_PAIRS, "pairs", "n").groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.n").alias("n")), "pairs")

    # bounded by the vocabularies
    image = _image(path_a, path_b)
    counted = np.zeros(len(image), np.int64)
    for r in regular.collect():
        counted[r["a"]] = r["n"]
    highest = np.zeros(1 << 20, np.int64)
    there = image >= 0
    np.maximum.at(highest, image[there], counted[there])
    for r in pairs.groupBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")).agg(F.max("n").alias("n")).collect():
        highest[r["b"]] = max(highest[r["b"]], r["n"])
    found = _most_frequent(pairs, most).toArrow()
    known, times = (found[c].to_numpy() for c in ("pair", "n"))
    order = np.argsort(known)
    known, times = known[order], times[order]
    sent = spark.sparkContext.broadcast((counted, (there & (counted == highest[image])).astype(np.int64), known, times, (times == highest[known & 0xFFFFFFFF]).astype(np.int64)))

    texts = rows.where(F.col("kind") == _TEXT)
    settled = staged(texts.select("doc_id", "row", "n_a", "n_b", "n_groups", "groups_sha256", "ids", "times", "pairs", "n").mapInArrow(_counted_rows(sent), _COUNTED), "settled")
    sent.destroy()
    rest = settled.select("row", F.explode(F.arrays_zip("pairs", "n")).alias("e")).select("row", F.col("e.pairs").alias("pair"), F.col("e.n").alias("times"))
    best = spark.createDataFrame(pa.table({"b": np.flatnonzero(highest), "highest": highest[highest > 0]}))
    ranked = pairs.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))).join(F.broadcast(best), "b")  # a row for each B id
    rare = rest.join(ranked, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return settled.join(rare, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _image(path_a: str, path_b: str) -> np.ndarray:
    return process_wide(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b)).same
