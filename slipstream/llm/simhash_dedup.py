"""Near duplicates by SimHash, with candidates found and pruned by the pigeonring principle.

Fingerprints of 64 bits are a ring of eight 8-bit segments. If two of them differ in at most ``d`` bits, some start on
the ring has, for every length, at most ``length * d / 8`` differing bits in the chain of segments that begins there.
For ``d = 3`` the first two segments of such a chain are equal and of the next three at least two are, so 24 keys of
32 equal bits bring every such pair together. Pairs of a key are then pruned by the budgets of the whole chain before
the Hamming distance is taken.

Only distinct fingerprints are compared, so exact copies cost one row. A key with more than ``block`` fingerprints is
divided by one more equal segment, as often as the distance allows, and dealt out anew: nothing is capped. Tasks emit a
spanning forest of the links they find, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import appended, free_name, raw_texts
from slipstream.llm.components import components
from slipstream.llm.staging import staged

SEGMENTS, WIDTH = 8, 8
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """Lower-cases A-Z; a bit is set if it is set in over half of the shingles' XXH64, repeats included; no word: 0."""
    words = text.lower().split()
    if not words:
        return 0
    hashed, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= shingle:
        return hashed(b" ".join(words), seed)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    found = [hashed(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return _majority(np.array(found, "<u8"))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16 if len(part) < 1 << 16 else np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a long (the same 64 bits). A null text is empty."""

    def made():
        def of(texts: pa.Array) -> pa.Array:
            return pa.array(np.array([fingerprint(t, shingle) for t in raw_texts(texts)], np.uint64).view(np.int64))

        return of

    return appended(docs, text, out, "long", made)


def _plan(distance: int) -> list[tuple[int, int]]:
    """For each key: where its chain starts, and the mask of segments that have to be equal."""
    if distance == 0:
        return [(0, (1 << SEGMENTS) - 1)]
    equal = (SEGMENTS - 1) // distance
    one_off = min(SEGMENTS, (2 * SEGMENTS - 1) // distance)
    plan = []
    for start in range(SEGMENTS):
        for left_out in range(equal, max(one_off, equal + 1)):
            chain = {(start + k) % SEGMENTS for k in range(one_off) if k != left_out}
            plan.append((start, sum(1 << s for s in chain)))
    return plan


def _bits(mask: int) -> int:
    """The segments of ``mask`` as a signed 64-bit mask of their bits."""
    whole = sum(((1 << WIDTH) - 1) << (WIDTH * s) for s in range(SEGMENTS) if mask >> s & 1)
    return whole - (1 << 64) if whole >> 63 else whole


def _keys(nodes: DataFrame, distance: int) -> DataFrame:
    keys = [F.struct(F.lit(start).alias("start"), F.lit(mask).alias("mask"), F.col("fp").bitwiseAND(F.lit(_bits(mask))).alias("part")) for start, mask in _plan(distance)]
    return nodes.select("fp", "node", F.explode(F.array(*keys)).alias("k")).select("k.start", "k.mask", "k.part", "fp", "node")


def _divided(rest: DataFrame) -> DataFrame:
    """Keys with one more equal segment for the fingerprints of keys that were too full."""

    def with_segment(s: int) -> Column:
        mask = F.col("mask").bitwiseOR(F.lit(1 << s))
        part = F.col("part").bitwiseOR(F.col("fp").bitwiseAND(F.lit(_bits(1 << s))))
        return F.when(F.col("mask").bitwiseAND(F.lit(1 << s)) == 0, F.struct("start", mask.alias("mask"), part.alias("part")))

    more = F.explode(F.array_compact(F.array(*[with_segment(s) for s in range(SEGMENTS)])))
    return rest.select("fp", "node", more.alias("k")).select("k.start", "k.mask", "k.part", "fp", "node")


def within_budget(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """Whether every prefix of the chain from ``start`` stays within its share of ``distance``."""
    differ = a ^ b
    turn = (start.astype(np.uint64) * np.uint64(WIDTH)) & np.uint64(63)
    back = (np.uint64(64) - turn) & np.uint64(63)
    ring = np.where(turn == 0, differ, (differ >> turn) | (differ << back))
    so_far = np.zeros(len(ring), np.int64)
    good = np.ones(len(ring), bool)
    for length in range(1, SEGMENTS + 1):
        so_far += np.bitwise_count((ring >> np.uint64(WIDTH * (length - 1))) & np.uint64((1 << WIDTH) - 1))
        good &= so_far * SEGMENTS <= length * distance
    return good


def _forest(a: np.ndarray, b: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links from each node to the least node it is connected to, for links between places ``a`` and ``b``."""
    ids, place = np.unique(nodes, return_inverse=True)
    a, b = place[a], place[b]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


_FOUND = "a long, b long, again boolean, start int, mask int, part long, fp long, node long"


def _compare(distance: int, block: int):
    """Compares the fingerprints of each key, whose rows arrive one after the other."""

    def emitted(a=(), b=(), again=None) -> pa.RecordBatch:
        n, m = len(a), 0 if again is None else len(again["fp"])
        link = lambda x: pa.array(np.concatenate([np.asarray(x, np.int64), np.zeros(m, np.int64)]), mask=np.arange(n + m) >= n)
        rest = lambda k, t: pa.array(np.concatenate([np.zeros(n, t), again[k].astype(t) if m else np.empty(0, t)]))
        return pa.RecordBatch.from_arrays(
            [link(a), link(b), pa.array(np.arange(n + m) >= n), rest("start", np.int32), rest("mask", np.int32), rest("part", np.int64), rest("fp", np.int64), rest("node", np.int64)],
            names=["a", "b", "again", "start", "mask", "part", "fp", "node"],
        )

    def links(rows: dict[str, np.ndarray], group: np.ndarray) -> pa.RecordBatch | None:
        fp, start, near_a, near_b = rows["fp"].view(np.uint64), rows["start"], [], []
        at, step = np.arange(len(fp)), 1
        while True:
            at = at[at + step < len(fp)]
            at = at[group[at] == group[at + step]]
            if not len(at):
                break
            hit = at[within_budget(fp[at], fp[at + step], start[at], distance)]
            hit = hit[np.bitwise_count(fp[hit] ^ fp[hit + step]) <= distance]
            near_a.append(hit)
            near_b.append(hit + step)
            step += 1
        if not near_a or not sum(map(len, near_a)):
            return None
        return emitted(*_forest(np.concatenate(near_a), np.concatenate(near_b), rows["node"]))

    def of(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Whole keys only."""
        n = len(rows["fp"])
        if not n:
            return
        edge = np.ones(n, bool)
        edge[1:] = (rows["start"][1:] != rows["start"][:-1]) | (rows["mask"][1:] != rows["mask"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
        group = np.cumsum(edge) - 1
        full = np.bincount(group)[group] > block
        full &= SEGMENTS - np.bitwise_count(rows["mask"].astype(np.uint32)) > distance  # else no further segment has to be equal
        if full.any():
            yield emitted(again={k: v[full] for k, v in rows.items()})
        small = ~full
        if (found := links({k: v[small] for k, v in rows.items()}, group[small])) is not None:
            yield found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "mask", "part", "fp", "node"]
        kept: list[dict[str, np.ndarray]] = []
        held = 0
        for batch in batches:
            rows = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            last = len(rows["fp"])
            if not last:
                continue
            same = np.flatnonzero((rows["start"] != rows["start"][-1]) | (rows["mask"] != rows["mask"][-1]) | (rows["part"] != rows["part"][-1]))
            cut = int(same[-1]) + 1 if len(same) else 0  # the last key may go on in the next batch
            kept.append({k: v[:cut] for k, v in rows.items()})
            held += cut
            if cut and (held > 4 * block or len(kept) > 8):
                yield from of({k: np.concatenate([x[k] for x in kept]) for k in names})
                kept, held = [], 0
            kept.append({k: v[cut:] for k, v in rows.items()})
            held += last - cut
        if kept:
            yield from of({k: np.concatenate([x[k] for x in kept]) for k in names})

    return work


def links(nodes: DataFrame, distance: int = 3, block: int = 8192) -> DataFrame:
    """Links ``(a, b)`` that connect any two nodes of ``nodes(fp, node)`` whose fingerprints differ in at most ``distance`` bits."""
    if not 0 <= distance < SEGMENTS:
        raise ValueError(f"distance must be between 0 and {SEGMENTS - 1}")
    keyed, found = _keys(nodes, distance), None
    while True:
        dealt = keyed.repartition("start", "mask", "part").sortWithinPartitions("start", "mask", "part")
        out = staged(dealt.mapInArrow(_compare(distance, block), _FOUND), "pairs")
        some = out.where("not again").select("a", "b")
        found = some if found is None else found.unionByName(some)
        rest = out.where("again").select("start", "mask", "part", "fp", "node")
        if rest.isEmpty():
            return found
        keyed = _divided(rest).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, block: int = 8192
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row: documents linked at ``distance`` bits or fewer, over any number of links.

    ``component_id`` is the smallest id reachable. Null and wordless texts have fingerprint 0 and link like others.
    Repeated rows give repeated rows. A row whose id is null gets the component of its fingerprint, or null if no row
    with an id is in it. Extra columns are not read. An empty table gives an empty result.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = staged(fingerprints(own, "text", shingle, "fp").select("doc_id", "fp"), "fingerprints")
    nodes = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "nodes")
    found = components(links(nodes, distance, block))
    classes = nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marks.join(classes, "fp", "left").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: that with the smallest id, once if it is repeated.

    Only rows equal in id and text are repeats; different texts of one id that is kept all stay. Rows with a null id cannot be
    named and stay. All columns are returned as they were.
    """
    found = near_duplicates(docs, doc_id, text, shingle, distance)
    keep = free_name(docs, "keep_id")
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias(keep)).distinct()
    left = docs.where(F.col(doc_id).isNotNull()).join(first, F.col(doc_id).cast("long") == F.col(keep), "left_semi")
    return left.dropDuplicates([doc_id, text]).unionByName(docs.where(F.col(doc_id).isNull()))


def as_hex(fingerprint: Column) -> Column:
    """Sixteen lowercase hex digits of a fingerprint held as a long."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
