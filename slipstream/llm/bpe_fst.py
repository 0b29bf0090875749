"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

**Encoding.** The merges decide, for any two neighbouring tokens, whether BPE leaves them apart; a sequence of tokens in
which it leaves all neighbours apart is the encoding of its bytes. So the last token of the encoding of every prefix is
unique, and the token that ends at one more byte begins at an open place: one from which the bytes read so far begin some
token. That is a transducer: its state is the bytes from the first open place on, with the last token at each open place; on
a byte it finds the token that ends there and fits the one before it, and emits the tokens that all open places agree on.
States and transitions are made lazily: a transition that an input needs for the first time is only simulated, place by
place; when it is needed again it is determinised, and from then on followed by one lookup. Tokens come out after a
lookahead of at most the longest token's bytes. All new pieces of a slice of texts are stepped together in numpy.

**Decoding.** A token's bytes are appended as they come; an incremental UTF-8 state machine turns them into text, holding
back at most three bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.arrowtext import slices
from slipstream.llm.subword import ChunkEncoder, Ragged, process_wide

RANKS = "byte_bpe_50k.tiktoken"
#: States, pieces and pairs of tokens that a worker remembers; beyond that they are made anew, so memory is bounded.
STATES, PIECES, PAIRS = 100_000, 300_000, 300_000
#: Pieces of a slice that have to need a transition before it is determinised for them, and bytes of a piece read alone.
OFTEN, LONG = 16, 64
#: Text that is encoded together; tokens that are decoded together.
SLICE_BYTES, STEP = 4 << 20, 1 << 14
#: A token's id is below 2 to this power.
PAIR_BITS = 24


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """What the ranks say of two neighbouring tokens."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # a trie of the tokens: node and byte to node
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.child.setdefault(key, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = rank
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[int, bool] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; none for a single byte."""
        if token not in self.parts:
            whole = self.bytes_of[token]
            pieces = [whole[k : k + 1] for k in range(len(whole))]
            while len(pieces) > 2:
                found = [self.ranks.get(a + b, token) for a, b in zip(pieces, pieces[1:], strict=False)]
                k = min(range(len(found)), key=found.__getitem__)
                if found[k] >= token:
                    break
                pieces[k : k + 2] = [pieces[k] + pieces[k + 1]]
            two = len(pieces) == 2 and all(p in self.ranks for p in pieces)
            self.parts[token] = (self.ranks[pieces[0]], self.ranks[pieces[1]]) if two else None
        return self.parts[token]

    def leaves_apart(self, a: int, b: int) -> bool:
        """Whether BPE encodes the bytes of tokens ``a`` and ``b`` as these two tokens.

        Merges are undone from the later one on. At each step the tokens that meet at the border would have to be merged
        before the merge that is undone next; if the vocabulary has such a merge, the border does not hold.
        """
        if len(self.apart) >= PAIRS:
            self.apart.clear()
        found = self.apart[a << PAIR_BITS | b] = self._leaves_apart(a, b)
        return found

    def _leaves_apart(self, a: int, b: int) -> bool:
        limit = 1 << 62
        while True:
            joined = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if joined is not None and joined < limit:
                return False
            left, right = self.split(a), self.split(b)
            if a > b:
                if left is None:
                    return True
                limit, a = a, left[1]
            else:
                if right is None:
                    if left is None:
                        return True
                    limit, a = a, left[1]
                    continue
                limit, b = b + 1, right[0]


class Numbers:
    """A hash table in numpy from non-negative 64-bit keys to 32-bit numbers; what is not there is -1."""

    def __init__(self, keys: np.ndarray = (), values: np.ndarray = ()) -> None:
        self.keys, self.values, self.used = np.full(1 << 10, -1, np.int64), np.full(1 << 10, -1, np.int32), 0
        self.add(np.asarray(keys, np.int64), np.asarray(values, np.int32))

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that are not there yet."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            there = self.keys >= 0
            keys, values = np.concatenate([self.keys[there], keys]), np.concatenate([self.values[there], values])
            size = 1 << (2 * self.used).bit_length()
            self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        at = self._place(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for one place, the last one written stays
            put = free & (self.keys[at] == keys)
            self.values[at[put]] = values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & (len(self.keys) - 1)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        found, at, asked = np.full(len(keys), -1, np.int32), self._place(keys), np.arange(len(keys))
        while len(asked):
            there = self.keys[at]
            same = there == keys
            found[asked[same]] = self.values[at[same]]
            on = ~same & (there >= 0)
            keys, asked, at = keys[on], asked[on], (at[on] + 1) & (len(self.keys) - 1)
        return found


class Simulation:
    """The reading of bytes that ``Transducer`` does for one piece, for many pieces together."""

    def __init__(self, merges: Merges) -> None:
        size = 1 + max(merges.bytes_of)
        pairs, self.left, self.right, self.size = {}, np.full(size, -1, np.int64), np.full(size, -1, np.int64), np.zeros(size, np.int64)
        for token, whole in merges.bytes_of.items():
            self.size[token] = len(whole)
            if (two := merges.split(token)) is not None:
                self.left[token], self.right[token] = two
            for k in range(1, len(whole)):
                a, b = merges.ranks.get(whole[:k]), merges.ranks.get(whole[k:])
                if a is not None and b is not None:
                    pairs[a << PAIR_BITS | b] = token
        self.joined = Numbers(list(pairs), list(pairs.values()))
        self.child = Numbers(list(merges.child), list(merges.child.values()))
        self.token_at = np.array(merges.token_at, np.int64)

    def leaves_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Merges.leaves_apart`` for many pairs."""
        found, asked, limit = np.ones(len(a), bool), np.arange(len(a)), np.full(len(a), 1 << 62)
        while len(asked):
            joined = self.joined[a << PAIR_BITS | b]
            met = (joined >= 0) & (joined < limit)
            found[asked[met]] = False
            by_left = (a > b) | (self.right[b] < 0)
            on = ~met & np.where(by_left, self.left[a] >= 0, True)
            limit, a, b = np.where(by_left, a, b + 1)[on], np.where(by_left, self.right[a], a)[on], np.where(by_left, b, self.left[b])[on]
            asked = asked[on]
        return found

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers; none is empty."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-sizes, kind="stable")  # those that still read are always the first ones
        sizes = sizes[order]
        longest = int(sizes[0])
        read = np.frombuffer(b"".join([pieces[k].ljust(longest, b"\0") for k in order.tolist()]), np.uint8).reshape(len(pieces), longest)
        last = np.full((len(pieces), longest), -1, np.int64)
        piece, place, node = np.arange(len(pieces)), np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        for k in range(longest):
            going = np.searchsorted(-sizes, -k, side="left")  # pieces longer than k
            if going < len(pieces):
                on = piece < going
                piece, place, node = piece[on], place[on], node[on]
            node = self.child[node << 8 | read[piece, k]].astype(np.int64)
            on = node >= 0
            piece, place, node = piece[on], place[on], node[on]
            token = self.token_at[node]
            ends = np.flatnonzero(token >= 0)
            p, at, t = piece[ends], place[ends], token[ends]
            later = np.flatnonzero(at > 0)
            fits = np.ones(len(ends), bool)
            fits[later] = self.leaves_apart(last[p[later], at[later] - 1], t[later])
            last[p[fits][::-1], k] = t[fits][::-1]  # the first open place counts, if more than one fits
            if (last[:going, k] < 0).any():
                raise ValueError("no token ends at some byte")
            begun = np.arange(going)
            piece, place, node = np.concatenate([piece, begun]), np.concatenate([place, np.full(going, k + 1)]), np.concatenate([node, np.zeros(going, np.int64)])
            if k + 1 < longest:
                near = np.argsort(piece, kind="stable")
                piece, place, node = piece[near], place[near], node[near]
        backwards, rows, left = [], np.arange(len(pieces)), sizes.copy()
        while len(rows):
            token = last[rows, left[rows] - 1]
            backwards.append((rows, token))
            left[rows] -= self.size[token]
            rows = rows[left[rows] > 0]
        tokens = np.concatenate([t for _, t in backwards[::-1]])
        near = np.argsort(np.concatenate([order[r] for r, _ in backwards[::-1]]), kind="stable")
        raw = tokens[near].astype("<u4").tobytes()
        ends = 4 * np.cumsum([0, *np.bincount(np.concatenate([order[r] for r, _ in backwards]), minlength=len(pieces)).tolist()])
        return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class Transducer:
    """Encodes one piece at a time. ``step`` maps a state and a byte to the tokens emitted and the next state.

    A state is the last emitted token (-1 at the beginning), the open places after it with their nodes in the trie of
    tokens, and the last token at each place of their encodings.
    """

    def __init__(self, merges: Merges, most: int = STATES) -> None:
        self.merges, self.most = merges, most
        self._begin()

    def _begin(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.step: dict[int, tuple[tuple[int, ...], int]] = {}
        self.asked: set[int] = set()
        self.rest: dict[int, tuple[int, ...]] = {}
        self._state((-1, ((0, 0),), ()))

    def _state(self, state: tuple) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
        return self.number[state]

    def _read(self, before: int, places: Sequence[tuple[int, int]], last: list[int], read: bytes) -> list[tuple[int, int]]:
        """Reads bytes: adds the token that ends at each to ``last`` and gives the places that stay open."""
        merges = self.merges
        child, token_at, apart = merges.child, merges.token_at, merges.apart
        for byte in read:
            after, chosen = [], -1
            for place, node in places:
                node = child.get(node << 8 | byte)
                if node is None:
                    continue
                after.append((place, node))
                if chosen < 0 and (token := token_at[node]) >= 0:
                    previous = last[place - 1] if place else before
                    if previous < 0:
                        chosen = token
                    else:
                        fits = apart.get(previous << PAIR_BITS | token)
                        if merges.leaves_apart(previous, token) if fits is None else fits:
                            chosen = token
            if chosen < 0:
                raise ValueError(f"no token ends at byte {byte}")
            last.append(chosen)
            after.append((len(last), 0))
            places = after
        return places

    def _path(self, last: Sequence[int], place: int) -> list[int]:
        found, bytes_of = [], self.merges.bytes_of
        while place:
            token = last[place - 1]
            found.append(token)
            place -= len(bytes_of[token])
        found.reverse()
        return found

    def _simulated(self, state: int, rest: bytes) -> list[int]:
        """The tokens of what is held in ``state`` and the ``rest`` of a piece."""
        before, places, last = self.states[state]
        last = list(last)
        self._read(before, places, last, rest)
        return self._path(last, len(last))

    def _follow(self, state: int, byte: int) -> tuple[tuple[int, ...], int]:
        """Determinises one transition."""
        before, places, last = self.states[state]
        last = list(last)
        places = self._read(before, places, last, bytes((byte,)))
        paths = [self._path(last, place) for place, _ in places]
        same = 0
        while all(len(p) > same and p[same] == paths[0][same] for p in paths):
            same += 1
        out = tuple(paths[0][:same])
        size = self.merges.bytes_of
        done = sum(len(size[t]) for t in out)
        kept = [-1] * len(last)
        for path in paths:
            place = done
            for token in path[same:]:
                place += len(size[token])
                kept[place - 1] = token
        after = tuple((place - done, node) for place, node in places)
        return out, self._state((out[-1] if out else before, after, tuple(kept[done:])))

    def __call__(self, piece: bytes) -> list[int]:
        if len(self.states) > self.most:
            self._begin()
        if len(self.asked) > 2 * self.most:
            self.asked.clear()
        out, at, step = [], 0, self.step
        for k, byte in enumerate(piece):
            key = at << 8 | byte
            found = step.get(key)
            if found is None:
                if key not in self.asked:
                    self.asked.add(key)
                    return out + self._simulated(at, piece[k:])
                found = step[key] = self._follow(at, byte)
            emitted, at = found
            if emitted:
                out += emitted
        out += self.ending(at)
        return out

    def ending(self, state: int) -> tuple[int, ...]:
        """The tokens that a state still holds when its piece ends."""
        if state not in self.rest:
            last = self.states[state][2]
            self.rest[state] = tuple(self._path(last, len(last)))
        return self.rest[state]


class Together:
    """Encodes new pieces together: one step of the transducer for all of them at each byte.

    A transition that ``OFTEN`` pieces need is determinised, if it is not yet; pieces that need a rarer one leave the
    transducer and are simulated together. Pieces of more than ``LONG`` bytes are read one by one.
    """

    def __init__(self, merges: Merges, most: int = STATES) -> None:
        self.transducer, self.single, self.simulated = Transducer(merges, most), Transducer(merges, most), Simulation(merges)
        self._begin()

    def _begin(self) -> None:
        self.transducer._begin()
        self.number, self.emitted, self.target = Numbers(), [()], np.zeros(1, np.int64)

    def _determinised(self, keys: list[int]) -> None:
        made = [self.transducer._follow(key >> 8, key & 255) for key in keys]
        self.number.add(np.array(keys), np.arange(len(self.emitted), len(self.emitted) + len(keys)))
        self.emitted += [out for out, _ in made]
        self.target = np.concatenate([self.target, np.array([to for _, to in made], np.int64)])

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces as little-endian unsigned 32-bit integers."""
        found: list[bytes] = [b""] * len(pieces)
        short = [k for k, p in enumerate(pieces) if 0 < len(p) <= LONG]
        for at in range(0, len(short), 1 << 16):
            part = short[at : at + (1 << 16)]
            for k, ids in zip(part, self._short([pieces[k] for k in part]), strict=True):
                found[k] = ids
        for k, piece in enumerate(pieces):
            if len(piece) > LONG:
                found[k] = np.array(self.single(piece), "<u4").tobytes()
        return found

    def _short(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.transducer.states) > self.transducer.most:
            self._begin()
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        longest = int(sizes.max())
        read = np.frombuffer(b"".join([p.ljust(longest, b"\0") for p in pieces]), np.uint8).reshape(len(pieces), longest)
        out: list[tuple[int, ...]] = [()] * len(pieces)
        on, state, left = np.arange(len(pieces)), np.zeros(len(pieces), np.int64), []
        for k in range(longest):
            key = state << 8 | read[on, k]
            step = self.number[key]
            if (step < 0).any():
                keys, times = np.unique(key[step < 0], return_counts=True)
                self._determinised(keys[times >= OFTEN].tolist())
                step = self.number[key]
                left.append(on[step < 0])
                on, step = on[step >= 0], step[step >= 0]
            state = self.target[step]
            for p, s in zip(on.tolist(), step.tolist(), strict=True):
                if self.emitted[s]:
                    out[p] += self.emitted[s]
            end = sizes[on] == k + 1
            for p, s in zip(on[end].tolist(), state[end].tolist(), strict=True):
                out[p] += self.transducer.ending(s)
            on, state = on[~end], state[~end]
        found = [np.array(o, "<u4").tobytes() for o in out]
        rare = np.concatenate([*left, np.empty(0, np.int64)]).astype(np.int64).tolist()
        if rare:
            for k, ids in zip(rare, self.simulated([pieces[k] for k in rare]), strict=True):
                found[k] = ids
        return found


def decode_stream(ids: Iterable[int], bytes_of: dict[int, bytes]) -> Iterator[str]:
    """Text as it becomes known, token by token; bytes that are not UTF-8 become U+FFFD."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for token in ids:
        if text := machine.decode(bytes_of[token]):
            yield text
    if text := machine.decode(b"", True):
        yield text


def encoder(path: str, pattern: str) -> ChunkEncoder:
    """An encoder of whole texts by the matches of ``pattern``, which has to begin a match at every space before something
    else than white space; it remembers pieces."""

    def make() -> ChunkEncoder:
        together = Together(Merges(read_ranks(path)))
        return ChunkEncoder(lambda pieces: together([p.encode() for p in pieces]), pattern, most=PIECES)

    return process_wide(("transducer", path, pattern), make)


class _Decoder:
    """Tokens' bytes and decimal ids of a rank file."""

    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.decimal = [str(rank) for rank in range(1 + max(self.bytes_of))]

    def texts(self, ids: Sequence[int]) -> Iterator[str]:
        """What ``decode_stream`` gives, many tokens at a step."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), STEP):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[at : at + STEP])))
        yield machine.decode(b"", True)

    def columns(self, ids: Ragged, text: bool) -> list[pa.Array]:
        """``n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``text`` for rows of ids."""
        digests, plain, texts = [], [], []
        for k in range(len(ids.starts) - 1):
            found = ids.row(k).tolist()
            digests.append(hashlib.sha256(" ".join(map(self.decimal.__getitem__, found)).encode()).hexdigest())
            decoded = "".join(self.texts(found))
            plain.append(hashlib.sha256(decoded.encode()).hexdigest())
            texts.append(decoded if text else None)
        columns = [pa.array(np.diff(ids.starts), pa.int64()), *[pa.array(x, pa.string()) for x in (digests, plain)]]
        return [*columns, pa.array(texts, pa.string())] if text else columns


_DECODED = ["n_tokens", "ids_sha256", "decoded_sha256", "text"]
_DECODED_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _own(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def encoded(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs``, repeated ones too; a null or empty text has no ids.

    A very long text is encoded in one task, in one go. An empty table gives an empty result. Other columns, whatever their
    names, are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern)
        for batch in slices(batches, 1, SLICE_BYTES):
            ids = encode(batch.column(1))
            listed = pa.ListArray.from_arrays(pa.array(ids.starts.astype(np.int32)), pa.array(ids.values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], names=["doc_id", "ids"])

    return _own(docs, doc_id, text).mapInArrow(work, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, text)`` for ``rows`` of ids; null ids are none.

    The digests are of the decimal ids joined by one space, and of ``text`` in UTF-8, which the streaming decoder gives. It
    is the tokens' bytes, but for such as are no UTF-8. Repeated rows stay; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = process_wide(("decoder", path), lambda: _Decoder(path))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes = part.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                found = Ragged(part.column(1).flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *sizes]))
                yield pa.RecordBatch.from_arrays([part.column(0), *decoder.columns(found, True)], names=["doc_id", *_DECODED])

    return rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(work, f"{_DECODED_SCHEMA}, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What ``decoded`` gives for ``encoded`` documents but ``text``, with one Python worker for each task instead of two."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, decoder = encoder(path, pattern), process_wide(("decoder", path), lambda: _Decoder(path))
        for batch in slices(batches, 1, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0), *decoder.columns(encode(batch.column(1)), False)], names=["doc_id", *_DECODED[:3]])

    return _own(docs, doc_id, text).mapInArrow(work, _DECODED_SCHEMA)
