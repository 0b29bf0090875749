"""Grouping of spelling variants: words one edit away from a much more frequent word.

The vocabulary is searched by FM-indexes in both directions. A word is cut in halves; a word near it has its first half as a
prefix or its second as a suffix. So the two search schemes match either half exactly from its delimiter on, and extend over
the other half, allowing one error, up to the other delimiter: the first in an index of the reversed words, where it extends
to the right, the second in an index of the words, where it extends to the left. States are suffix-rank intervals; all
queries of a block go on together in numpy. Since both schemes begin at a delimiter, the two directions need not be kept in
step.

Spark deals words and queries to cells by scheme, length and half, so a query meets only words that may answer it. A task
joins its cells to indexes of bounded size. A cell of too many words is divided into a grid of blocks of words and parts of
queries. Every pair of near words is found once, and counted in the task that finds it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import flat, slices
from slipstream.llm.staging import remove, staged

LEAST_LENGTH, LEAST_COUNT, RATIO, SLIPS = 6, 5, 5, 199
#: Words of a cell beyond which it is divided; letters of an index; queries that are searched together.
CELL, LETTERS, QUERIES = 1 << 13, 1 << 17, 1 << 15
SAMPLE = 8
SLICE_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF in UTF-8


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _crc32(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of ``data``, each after what gave the CRC-32 ``state``."""
    order = np.argsort(starts - ends, kind="stable")
    sizes, at = (ends - starts)[order], starts[order]
    now = ~state[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        going = int(np.searchsorted(-sizes, -k, side="left"))  # spans longer than k
        now[:going] = _CRC[(now[:going] ^ data[at[:going] + k]) & 0xFF] ^ now[:going] >> 8
    found = np.empty_like(now)
    found[order] = ~now
    return found


def _runs(texts: pa.Array, ids: list[int | None], least: int, slips: int) -> tuple[pa.Array, list[str]]:
    """The runs of letters of all texts that have ``least`` code points or more: those as they are, and those with a slip."""
    data, offsets = flat(texts)
    data = _LOWER[data]
    lead = data == _LEAD
    letter = _LETTER[data] | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = letter[1:] != letter[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = letter[starts] if len(starts) else np.empty(0, bool)
    starts, ends = starts[real], ends[real]
    before = np.concatenate([[0], np.cumsum(lead)])
    points = ends - starts - (before[ends] - before[starts])
    long = points >= least
    starts, ends, points = starts[long], ends[long], points[long]
    text = np.searchsorted(offsets, starts, side="right") - 1
    state = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = _crc32(state[text], data, starts, ends).astype(np.int64)
    slip = crc % slips == 0
    changed = []
    for k in np.flatnonzero(slip).tolist():
        run, place = data[starts[k] : ends[k]].tobytes().decode(), int(crc[k] % points[k])
        if points[k] > least:
            changed.append(run[:place] + run[place + 1 :])
    starts, ends = starts[~slip], ends[~slip]
    kept = np.zeros(len(data) + 1, np.int8)
    kept[starts] += 1
    kept[ends] -= 1
    letters = data[np.cumsum(kept[:-1]).astype(bool)] if len(data) else data
    places = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(letters.tobytes())), changed


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slips: int = SLIPS) -> DataFrame:
    """``(word, n)``: words of at least ``least_length`` code points that occur ``least_count`` times or more.

    A word is a run of letters, A-Z lower-cased; where ``slips`` divides the CRC-32 of ``<doc_id>:<run>``, the run's code
    point at the CRC-32 modulo its length is left out. A null text has no words; a null id is spelled empty.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE_BYTES):
            plain, changed = _runs(batch.column(1), batch.column(0).to_pylist(), least_length, slips)
            for words in (plain, pa.array(changed, pa.large_string())):
                found = words.value_counts()
                yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Index:
    """An FM-index over delimited words, which are sorted and distinct: intervals of suffix ranks are extended to the left.

    Each word is followed by a delimiter of its own, which sorts before all letters and as the words do; it also counts as
    the letter before the word. So the suffixes that begin with delimiters are the first, in the order of the words.
    """

    def __init__(self, words: list[str]) -> None:
        self.n = n = len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(points)
        sizes = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(len(points) + n, np.int64)
        delimiter = np.zeros(len(text), bool)
        delimiter[ends] = True
        text[~delimiter] = np.searchsorted(self.alphabet, points) + 1
        suffixes = self._sorted(np.where(delimiter, np.cumsum(delimiter) - 1, text + n))
        first = np.zeros(len(text), bool)
        first[np.concatenate([[0], ends[:-1] + 1])] = True
        last = np.where(first, 0, np.concatenate([[0], text[:-1]]))[suffixes].astype(np.uint8 if len(self.alphabet) < 255 else np.int32)
        self.sigma = len(self.alphabet) + 1
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        rows = -(-(len(last) + 1) // SAMPLE)
        padded = np.full(rows * SAMPLE, self.sigma, np.int32)
        padded[: len(last)] = last
        self.rows = padded.reshape(rows, SAMPLE)
        times = np.bincount((np.arange(rows * SAMPLE) // SAMPLE) * (self.sigma + 1) + padded, minlength=rows * (self.sigma + 1)).reshape(rows, self.sigma + 1)
        self.before = np.zeros((rows, self.sigma), np.int32)
        np.cumsum(times[:-1, : self.sigma], axis=0, out=self.before[1:])

    @staticmethod
    def _sorted(text: np.ndarray) -> np.ndarray:
        """The suffix array of a text whose suffixes differ before any of them ends, by prefix doubling."""
        rank, step = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        while True:
            key = rank * (len(text) + 1)
            key[:-step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank[order] = new
            if new[-1] == len(text) - 1:
                return order
            step *= 2

    def rank(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``letter`` is before the suffixes that rank below ``at``."""
        row = at // SAMPLE
        return self.before[row, letter] + ((self.rows[row] == letter[:, None]) & (np.arange(SAMPLE) < (at % SAMPLE)[:, None])).sum(axis=1)

    def ranks(self, at: np.ndarray) -> np.ndarray:
        """``rank`` of every letter."""
        row, rest = at // SAMPLE, at % SAMPLE
        found = self.before[row].astype(np.int64)
        for k in range(SAMPLE - 1):
            here = np.flatnonzero(k < rest)
            found[here, self.rows[row[here], k]] += 1
        return found

    def extended(self, letter: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.begin[letter] + self.rank(letter, low), self.begin[letter] + self.rank(letter, high)

    def near(self, queries: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, word) one edit apart in which the last ``exact`` letters of the query end the word as they are."""
        sizes = np.fromiter(map(len, queries), np.int64, len(queries))
        points = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4")
        place = np.searchsorted(self.alphabet, points)
        known = self.alphabet[np.minimum(place, len(self.alphabet) - 1)] == points
        letters, ends = np.where(known, place + 1, -1), np.cumsum(sizes)  # -1 is in no word
        who = np.arange(len(queries))
        low, high, left = np.zeros(len(queries), np.int64), np.full(len(queries), self.n), sizes.copy()
        starts = ends - sizes

        def read(state: tuple) -> tuple:
            """Reads the next letter of each query to the left; intervals that become empty go."""
            who, low, high, left = state
            letter = letters[starts[who] + left - 1]
            on = letter >= 0
            who, left, letter = who[on], left[on] - 1, letter[on]
            low, high = self.extended(letter, low[on], high[on])
            on = low < high
            return who[on], low[on], high[on], left[on]

        done: list[tuple] = []
        state = (who, low, high, left)
        while len(state[0]):
            more = state[3] > (sizes - exact)[state[0]]
            done.append(tuple(x[~more] for x in state))
            state = read(tuple(x[more] for x in state))
        state = tuple(np.concatenate(x) for x in zip(*done, strict=True))
        pairs = [np.empty((2, 0), np.int64)]
        while len(state[0]):
            who, low, high, left = state
            below, upto = self.ranks(low), self.ranks(high)
            k, letter = np.nonzero(upto[:, 1:] > below[:, 1:])
            letter += 1
            a, b = self.begin[letter] + below[k, letter], self.begin[letter] + upto[k, letter]
            rest = left > 0
            wanted = np.where(rest, letters[starts[who] + np.maximum(left, 1) - 1], 0)
            other = rest[k] & (letter != wanted[k])
            one = [  # a letter more in the word, another letter, a letter less
                (who[k], a, b, left[k]),
                (who[k][other], a[other], b[other], left[k][other] - 1),
                (who[rest], low[rest], high[rest], left[rest] - 1),
            ]
            pairs.append(self._finished(tuple(np.concatenate(x) for x in zip(*one, strict=True)), read))
            state = read(tuple(x[rest] for x in state))
        both = np.concatenate(pairs, axis=1)
        found = np.unique(both[0] * self.n + both[1])
        return found // self.n, found % self.n

    def _finished(self, state: tuple, read) -> np.ndarray:
        """Queries and words of the states that reach a delimiter without a further error."""
        found = [np.empty((2, 0), np.int64)]
        while len(state[0]):
            end = state[3] == 0
            who, low, high, _ = (x[end] for x in state)
            low, high = self.extended(np.zeros(len(who), np.int64), low, high)
            sizes = np.maximum(high - low, 0)
            words = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            found.append(np.stack([np.repeat(who, sizes), words]))
            state = read(tuple(x[~end] for x in state))
        return np.concatenate(found, axis=1)


class _Block:
    """Cells whose words are in one index, and the queries that wait for it."""

    def __init__(self) -> None:
        self.words: list[tuple[str, str, int]] = []  # word as indexed, cell, n
        self.letters, self.queries, self.made = 0, [], None

    def answers(self) -> Iterator[tuple[str, int, int, str]]:
        """``(word, near, n, form)`` of the queries that have near words: how many, and the one of largest ``n``."""
        queries, self.queries = self.queries, []
        if not queries or not self.words:
            return
        # a block holds cells of both schemes: words are told apart by their cell, so each is indexed as often as it is dealt
        if self.made is None:
            self.made = Index(sorted({w for w, _, _ in self.words}))
            self.place = {}
            for word, cell, n in self.words:
                self.place.setdefault(word, []).append((cell, n))
            self.sorted = sorted(self.place)
        exact = np.fromiter((len(w) // 2 if side == 0 else len(w) - len(w) // 2 for w, _, side in queries), np.int64, len(queries))
        best: dict[int, tuple[int, int, str]] = {}
        for q, k in zip(*(x.tolist() for x in self.made.near([w for w, _, _ in queries], exact)), strict=True):
            word, cell, side = queries[q]
            form = self.sorted[k]
            n = next((n for c, n in self.place[form] if c == cell), None)
            if n is None or side and form[: len(word) // 2] == word[: len(word) // 2]:
                continue  # in another cell, or found by the first scheme
            form = form if side else form[::-1]
            near, most, least = best.get(q, (0, 0, ""))
            best[q] = (near + 1, n, form) if n > most or n == most and form < least else (near + 1, most, least)
        for q, (near, n, form) in best.items():
            word, _, side = queries[q]
            yield word if side else word[::-1], near, n, form


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cell, kind, side, word, n)`` ordered by cell and kind (words, then queries) to answers."""
    block, now = _Block(), None

    def given(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*found, strict=True))
        if columns:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n_near", "n", "form"])

    for batch in batches:
        for cell, kind, side, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if cell != now:
                now, alone = cell, True
                if block.letters >= LETTERS or block.made is not None:
                    yield from given(block.answers())
                    block = _Block()
            if kind == 0:
                alone = False
                block.words.append((word, cell, n))
                block.letters += len(word) + 1
            elif not alone:
                block.queries.append((word, cell, side))
                if len(block.queries) >= QUERIES:
                    yield from given(block.answers())
    yield from given(block.answers())


def _cells(words: DataFrame, least: int, most: int) -> DataFrame:
    """Words and queries of both schemes in their cells; words of the first scheme are reversed."""
    length = F.length("word")

    def dealt(kind: int, of) -> DataFrame:
        half = (F.greatest(of - 1, F.lit(least)) / 2).cast("int")  # no longer than the half of any query for this length
        end = lambda side: F.left("word", half) if side == 0 else F.right("word", half)
        sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), end(s).alias("half")) for s in (0, 1)]))
        return words.withColumn("of", of).withColumn("s", sides).select(F.lit(kind).alias("kind"), "s.side", "of", "s.half", "word", "n")

    queries = words.select("word", "n", F.explode(F.array(length - 1, length, length + 1)).alias("for")).where(F.col("for") >= least)
    words, index = queries, dealt(0, length)
    asked = dealt(1, F.col("for"))
    # a cell of many words becomes a grid: words by blocks, each copied for every part of its queries, and the other way round
    hot = index.groupBy("side", "of", "half").agg(F.count("*").alias("size")).where(F.col("size") > most)
    hot = hot.select("side", "of", "half", F.ceil(F.col("size") / most).cast("int").alias("blocks"))
    rows = index.unionByName(asked).join(hot, ["side", "of", "half"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own, copies = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"), F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = rows.select("*", own.alias("own"), F.explode(copies).alias("copy"))
    word_block, part = F.when(F.col("kind") == 0, F.col("own")).otherwise(F.col("copy")), F.when(F.col("kind") == 0, F.col("copy")).otherwise(F.col("own"))
    cell = F.concat_ws("|", "side", "of", "half", word_block, part)
    return rows.select(cell.alias("cell"), "kind", "side", F.when(F.col("side") == 0, F.reverse("word")).otherwise(F.col("word")).alias("word"), "n")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = CELL) -> DataFrame:
    """``(word, n_near, near_n, near_word)`` for the words of ``words(word, n)`` that have near words in it: how many, the
    largest ``n`` of them, and the word that has it (the smallest of several). Words are distinct, of ``least_length`` code
    points or more, and at least two."""
    if least_length < 2:
        raise ValueError("words of one code point have no halves")
    cells = _cells(words, least_length, most).repartition("cell").sortWithinPartitions("cell", "kind")
    found = cells.mapInArrow(_searched, "word string, n_near long, n long, form string")
    best = F.min(F.struct((-F.col("n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.form").alias("near_word"))


def _rooted(forms: DataFrame) -> DataFrame:
    """``(word, form, root)`` of ``forms(word, form)``: pointers are doubled until none moves. A form has a larger count than
    its word by a factor, so a chain is no longer than the logarithm of the largest count."""
    spark = forms.sparkSession
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    moves = True
    while moves:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        following = staged(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moves = following.where("moved").limit(1).count() > 0
        for path in {f.rpartition("/")[0] for f in now.inputFiles()}:
            remove(spark, path)
        now = following.drop("moved")
    return forms.join(now, "word")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, slips: int = SLIPS, most: int = CELL) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``vocabulary``.

    ``form`` is the near word of largest count, if that is at least ``ratio`` times the word's; ``root`` is where forms lead.
    Null and empty texts have no words, repeated rows count each, a null id is spelled empty, an empty table gives an empty
    result, words of any length are searched. Other columns, whatever their names, are not read. ``most`` changes no result.
    """
    if ratio < 2:
        raise ValueError("forms have to be more frequent than their words")
    words = staged(vocabulary(docs, doc_id, text, least_length, least_count, slips), "vocabulary")
    near = staged(near_words(words, least_length, most), "near")
    joined = words.join(near, "word", "left").withColumn("is_form", F.col("near_n") >= F.lit(ratio) * F.col("n"))
    own = staged(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("near_word")).alias("form"), F.when(F.col("is_form"), F.col("near_n")).alias("form_n")), "forms")
    roots = _rooted(own.where("form is not null").select("word", "form")).select("word", "root")
    return own.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
