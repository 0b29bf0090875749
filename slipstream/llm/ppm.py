"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts. Its symbols are the bytes of the lower-cased words, one space between two, and an end
after the last. A context's symbols are predicted by their counts less a half; an escape, with half the weight of the
number of the context's different symbols (method D), leads to the context one shorter, where symbols of the longer one
are excluded. Below the empty context all symbols that are left are equally likely.

**Training** counts the n-grams of the longest order in every task and adds them up in one exchange, which grows with the
corpus; counts of shorter contexts are sums of these. Totals, distinct symbols and exclusions of a context are taken from all
of its nodes.

**Scoring** is exact. A symbol's probability depends on its key alone, the last ``ORDER`` symbols and itself. At most
``most_nodes`` keys, those that training has most often, are broadcast with their probabilities. All other keys are counted
per text; the different ones meet the whole tables, order by order, and their probabilities meet the counts in a join.

Base scores need the count of every token of an open vocabulary. Tokens with more than one in ``FREQUENT`` of all counts
(there cannot be more than that many) are broadcast; the others meet their counts in a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import flat, mix, runs, slices, span_hashes
from slipstream.llm.staging import staged

ORDER, BITS = 5, 8
#: The end is spelled as a byte that no word has. All other bytes but white space are symbols, and so is the space.
END, SPACE, SYMBOLS = 0x09, 0x20, 252
FREQUENT = 1 << 19
SLICE = 2 << 20

_NOT_SPACE = np.ones(256, np.uint8)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Table:
    """Distinct long keys with their places in a list, by open addressing, looked up in whole arrays."""

    def __init__(self, keys: np.ndarray) -> None:
        self.n = len(keys)
        size = 1 << max(2 * self.n, 16).bit_length()
        self.mask = size - 1
        self.keys, self.place = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        left = np.arange(self.n)
        at = self._home(keys)
        while len(left):
            free = self.place[at] < 0
            self.place[at[free]] = left[free]  # of several that want a slot one gets it
            won = self.place[at] == left
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        at = self._home(keys)
        found = self.place[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            there = self.place[at[open_]]
            found[open_] = there
            open_ = open_[(there >= 0) & (self.keys[at[open_]] != keys[open_])]
        return found


class Words:
    """Lower-cased words of a batch of texts."""

    def __init__(self, texts: pa.Array) -> None:
        data, self.offsets = flat(texts)
        self.data = _LOWER[data]
        self.starts, self.ends, self.first = runs(self.data, self.offsets, _NOT_SPACE)
        self.n_words = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends).view(np.int64)

    def stream(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all texts, each after ``ORDER`` ends and followed by one; and where each text begins and ends."""
        keep = _NOT_SPACE[self.data] > 0
        symbols = self.data.copy()
        inner = np.ones(len(self.starts), bool)
        inner[self.first[:-1][self.n_words > 0]] = False
        gaps = self.starts[inner] - 1
        keep[gaps], symbols[gaps] = True, SPACE
        before = np.concatenate([[0], np.cumsum(keep)])[self.offsets]
        length = np.diff(before)
        begin = before[:-1] + (ORDER + 1) * np.arange(len(length)) + ORDER
        out = np.full(int(before[-1]) + (ORDER + 1) * len(length), END, np.uint8)
        shift = np.repeat(begin - before[:-1], length)
        out[np.arange(len(shift)) + shift] = symbols[keep]
        return out, begin, begin + length


def _keys(stream: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The key of the last ``ORDER`` symbols and the next, at each symbol of each text and its end."""
    wide = np.zeros(len(stream), np.int64)
    for back in range(ORDER, -1, -1):
        wide[ORDER:] = (wide[ORDER:] << BITS) | stream[ORDER - back : len(stream) - back]
    scored = np.ones(len(stream), bool)
    pads = (begin[:, None] - np.arange(1, ORDER + 1)[None, :]).ravel()
    scored[pads] = False
    return wide[scored]


def _trains(ids: pa.Array, held: int) -> np.ndarray:
    """Whether the CRC-32 of the id as text leaves a remainder other than ``held`` modulo 5; a null id is an empty text."""
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 != held for i in ids.to_pylist()], bool)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts of several sorted lists."""
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(counts, at)


class _Sums:
    """Counts by key, merged as they come."""

    def __init__(self, most: int = 1 << 21) -> None:
        self.parts, self.held, self.most = [], 0, most

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            found = np.unique(keys, return_counts=True)
            self.parts.append(found)
            self.held += len(found[0])
            if self.held > 2 * self.most:
                self.parts = [_added(self.parts)]
                self.held = len(self.parts[0][0])

    def taken(self, over: int = 0) -> tuple[np.ndarray, np.ndarray] | None:
        """All counts, if there are more than ``over``; they are then begun anew."""
        if not self.parts or self.held <= over:
            return None
        found, self.parts, self.held = _added(self.parts), [], 0
        return found


def _table(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["kind", "key", "n"])


_TOKEN, _TEXTS = 0, 1


def _token_rows(held: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = _Sums(), 0
        for batch in slices(batches, 1, SLICE):
            chosen, words = _trains(batch.column(0), held), Words(batch.column(1))
            sums.add(words.hashes()[np.repeat(chosen, words.n_words)])
            texts += int(chosen.sum())
            if (found := sums.taken(4 * sums.most)) is not None:
                yield _table(_TOKEN, *found)
        if (found := sums.taken()) is not None:
            yield _table(_TOKEN, *found)
        yield _table(_TEXTS, np.zeros(1), np.array([texts]))

    return work


def _gram_rows(held: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in slices(batches, 1, SLICE):
            some = batch.filter(pa.array(_trains(batch.column(0), held)))
            if some.num_rows:
                sums.add(_keys(*Words(some.column(1)).stream()[:2]))
            if (found := sums.taken(4 * sums.most)) is not None:
                yield _table(_TOKEN, *found)
        if (found := sums.taken()) is not None:
            yield _table(_TOKEN, *found)

    return work


_COUNTS = "kind int, key long, n long"


def _most_frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows of ``table`` with a count ``n`` from the least that leaves at most ``most`` rows.

    The least count is found by halving on sums of one row each.
    """
    low, high = 1, 1 + (table.agg(F.max("n")).first()[0] or 0)
    steps = [1]
    while steps[-1] * 2 < high:
        steps.append(steps[-1] * 2)
    row = table.agg(*[F.count_if(F.col("n") >= s).alias(f"c{k}") for k, s in enumerate(steps)]).first()
    over = [s for k, s in enumerate(steps) if row[k] > most]
    low = over[-1] if over else 0  # too many from here
    high = next((s for s in steps if s > low), high)  # few enough from here
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if table.where(F.col("n") >= middle).count() > most else (low, middle)
    return table.where(F.col("n") >= high)


def _collected(table: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns of a bounded table."""
    found = table.select(*columns).toArrow()
    return [found[c].to_numpy() for c in columns]


#: Shorter orders than this have at most 2^16 nodes, so their tables are broadcast.
SMALL = 2


def _suffix(symbols: int) -> Column:
    return F.col("key").bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def _few(table: DataFrame, order: int) -> DataFrame:
    return F.broadcast(table) if order < SMALL else table


def train(docs: DataFrame, held: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All nodes ``(key, n)`` and all contexts ``(context, total, kinds, below)`` of each order, of the training documents in
    ``docs(doc_id, text)``."""
    grams = staged(docs.mapInArrow(_gram_rows(held), _COUNTS).groupBy("key").agg(F.sum("n").alias("n")), "grams")
    nodes = [grams]
    for order in range(ORDER - 1, -1, -1):
        nodes.insert(0, staged(nodes[0].groupBy(_suffix(order + 1).alias("key")).agg(F.sum("n").alias("n")), "grams"))
    contexts = []
    for order, table in enumerate(nodes):
        below = table.withColumn("m", F.lit(0).cast("long"))
        if order:
            lower = _few(nodes[order - 1].select(F.col("key").alias("inner"), F.col("n").alias("m")), order - 1)
            below = table.join(lower, _suffix(order) == F.col("inner"))
        sums = below.groupBy(F.shiftright("key", BITS).alias("context")).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("below"))
        contexts.append(staged(sums, "contexts"))
    return nodes, contexts


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """log10 probability of each key from its count, and its contexts' totals, kinds and exclusions, in every order."""
    for batch in batches:
        of = lambda name, batch=batch: batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(float)
        score, shut_sum, shut_n = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        active = np.ones(batch.num_rows, bool)
        for order in range(ORDER, -1, -1):
            n, total, distinct, below = (of(f"{name}{order}") for name in ("n", "total", "kinds", "below"))
            known = active & (total > 0)
            hit = known & (n > 0)
            kinds, weight = distinct - shut_n, 2 * (total - shut_sum)
            score[hit] += np.log10((2 * n[hit] - 1) / weight[hit])
            miss = known & ~hit
            some = miss & (kinds > 0)
            score[some] += np.log10(kinds[some] / weight[some])
            active &= ~hit
            shut_sum, shut_n = np.where(miss, below, 0), np.where(miss, distinct, 0)
        score[active] -= np.log10(np.maximum(SYMBOLS - shut_n[active], 1))
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(score)], names=["key", "logp"])


def probabilities(keys: DataFrame, nodes: list[DataFrame], contexts: list[DataFrame]) -> DataFrame:
    """``(key, logp)`` of different ``keys(key)`` by the whole model."""
    for order in range(ORDER, -1, -1):
        node = nodes[order].select(F.col("key").alias("node"), F.col("n").alias(f"n{order}"))
        keys = keys.join(_few(node, order), _suffix(order + 1) == F.col("node"), "left").drop("node")
        context = contexts[order].select(F.col("context"), *[F.col(c).alias(f"{c}{order}") for c in ("total", "kinds", "below")])
        keys = keys.join(_few(context, order), F.shiftright(_suffix(order + 1), BITS) == F.col("context"), "left").drop("context")
    return keys.mapInArrow(_chained, "key long, logp double")


class Settled:
    """Scores the keys that are broadcast; counts the others."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray) -> None:
        self.table, self.logs = Table(keys), logs

    def texts(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What each text scores by broadcast keys; and text, key and count of each other key of a text."""
        stream, begin, end = words.stream()
        keys = _keys(stream, begin)
        text = np.repeat(np.arange(len(begin)), end - begin + 1)
        place = self.table.find(keys)
        hit = place >= 0
        total = np.bincount(text[hit], weights=self.logs[place[hit]], minlength=len(begin)).astype(float)
        keys, text = keys[~hit], text[~hit]
        order = np.lexsort((keys, text))
        keys, text = keys[order], text[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        return total, text[at], keys[at], np.diff(np.append(at, len(keys)))


_SCORES = "doc_id long, copy long, held_out boolean, n_tokens long, n_known long, base double, score double, hash long, gram long, times long"


def _score_rows(settled, frequent, held: int):
    """A row for each document, with sums over its frequent tokens and keys; and one for each of its other tokens, by hash,
    and for each of its other keys, with their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Settled(*settled.value)
        keys, counts = frequent.value
        table, logs = Table(keys), np.log10(counts + 0.5)
        for batch in slices(batches, 1, SLICE):
            words = Words(batch.column(1))
            hashes = words.hashes()
            of = np.repeat(np.arange(batch.num_rows), words.n_words)
            place = table.find(hashes)
            known = place >= 0
            base = np.bincount(of[known], weights=logs[place[known]], minlength=batch.num_rows).astype(float)
            n_known = np.bincount(of[known], minlength=batch.num_rows)
            score, text, gram, times = scorer.texts(words)
            rows, rest = batch.num_rows, of[~known]
            tokens = rows + len(rest)
            total = tokens + len(text)
            own, is_token, is_gram = (np.arange(total) < rows, np.zeros(total, bool), np.arange(total) >= tokens)
            is_token[rows:tokens] = True
            who = pa.array(np.concatenate([np.arange(rows), rest, text]))

            def column(values: np.ndarray, kind: pa.DataType, at: np.ndarray = own) -> pa.Array:
                padded = np.zeros(total, values.dtype)
                padded[at] = values
                return pa.array(padded, kind, mask=~at)

            columns = [
                batch.column(0).take(who), batch.column(2).take(who), column(~_trains(batch.column(0), held), pa.bool_()), column(words.n_words + 1, pa.int64()),
                column(n_known, pa.int64()), column(base, pa.float64()), column(score, pa.float64()), column(hashes[~known], pa.int64(), is_token),
                column(gram, pa.int64(), is_gram), column(times, pa.int64(), is_gram),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "held_out", "n_tokens", "n_known", "base", "score", "hash", "gram", "times"])

    return work


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held: int = 1, most_nodes: int = 1 << 19) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    Documents whose CRC-32 of the id as text leaves ``held`` modulo 5 are held out; the model and the base counts learn from
    all others, repeated rows as often as they are repeated. A null or empty text is the end alone. A null id counts as an
    empty id text, so it is trained on. A very long text is read whole, in one task. With nothing to learn from, all symbols are equally likely and no token is known.
    An empty table gives an empty result. Other columns, whatever their names, are not read. ``most_nodes`` bounds what is broadcast and changes no score.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = own.mapInArrow(_token_rows(held), _COUNTS).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    tables = staged(counted, "tokens")
    tokens = tables.where(F.col("kind") == _TOKEN).select("key", "n")
    words, kinds = tokens.agg(F.sum("n"), F.count("*")).first()
    ends = sum(r["n"] for r in tables.where(F.col("kind") == _TEXTS).collect())
    total, vocabulary = (words or 0) + ends, kinds + (ends > 0)
    nodes, contexts = train(own, held)

    often = _most_frequent(nodes[ORDER], most_nodes)
    top = often.join(contexts[ORDER].select("context", "total"), F.shiftright("key", BITS) == F.col("context"))
    keys, counts, totals = _collected(top, "key", "n", "total")
    settled = (keys, np.log10((2 * counts - 1) / (2 * totals)))
    sent = [spark.sparkContext.broadcast(x) for x in (settled, tuple(_collected(tokens.where(F.col("n") > total // FREQUENT), "key", "n")))]
    del keys, counts, totals, settled
    rows = staged(own.withColumn("copy", F.xxhash64("text")).mapInArrow(_score_rows(*sent, held), _SCORES), "scores")
    for x in sent:
        x.destroy()

    rest = rows.where("hash is not null").select("doc_id", "copy", "hash")
    rare = rest.join(tokens.withColumnRenamed("key", "hash"), "hash", "left").groupBy("doc_id", "copy")
    sums = staged(rare.agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("rare_base"), F.count_if(F.col("n") > 0).alias("rare_known")), "sums")
    others = rows.where("gram is not null").select("doc_id", "copy", F.col("gram").alias("key"), F.col("times").alias("n_gram"))
    found = staged(probabilities(others.select("key").distinct(), nodes, contexts), "probabilities")
    grams = staged(others.join(found, "key").groupBy("doc_id", "copy").agg(F.sum(F.col("n_gram") * F.col("logp")).alias("rare_score")), "sums")
    each = rows.where("hash is null and gram is null").drop("hash", "gram", "times")
    each = each.groupBy("doc_id", "copy", "held_out", "n_tokens", "n_known", "base").agg(F.count("*").alias("times"), F.min("score").alias("score"))
    joined = each
    for table in (sums, grams):
        named = table.withColumnsRenamed({"doc_id": "d", "copy": "c"})
        joined = joined.join(named, joined["doc_id"].eqNullSafe(named["d"]) & (joined["copy"] == named["c"]), "left").drop("d", "c")
    log_total = float(np.log10(total + 0.5 * (vocabulary + 1)))
    end_base = float(np.log10(ends + 0.5))
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) / F.col("times") + F.lit(end_base) - F.col("n_tokens") * F.lit(log_total)
    score = F.col("score") + F.coalesce("rare_score", F.lit(0.0)) / F.col("times")
    known = F.col("n_known") + F.floor(F.coalesce("rare_known", F.lit(0)) / F.col("times")) + F.lit(int(ends > 0))
    return joined.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score")
    )
