"""Token ids of whole texts, each distinct chunk of a slice of texts encoded once.

Texts are cut at every space that precedes something other than white space: there the first pattern of the vocabularies used
begins a match, and no token reaches over it, so the encodings of the chunks, one after the other, are that of the text.
Arrow cuts a slice and numbers its distinct chunks; only these are met in Python, and numpy deals their ids to the texts.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

VOCABULARY = "byte_bpe_50k.json"
#: Matches of the pattern that a worker remembers in each of two generations.
CACHE = 300_000

#: A space before something other than white space; and one that no other space precedes.
CUT = re.compile(r" (?=[^\s\x1c-\x1f])")
LONE_CUT = re.compile(r"(?<! ) (?=[^\s\x1c-\x1f])")
#: Fixed value: the pattern of byte-level pre-tokenizers of the tokenizers library.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def public_path(name: str) -> str:
    """Where the installed public tokenizer file ``name`` is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Divided(NamedTuple):
    """Texts in chunks: the distinct ones, and for every text the numbers of its own.

    Numbers below ``len(heads)`` are chunks as they stand; the others are ``bodies``, words without a space, each after a cut
    space. ``codes[starts[k]:starts[k + 1]]`` are the numbers of the k-th text.
    """

    heads: list[str]
    bodies: list[str]
    codes: np.ndarray
    starts: np.ndarray


def strings_of(texts: pa.Array) -> list[str]:
    """The strings of an array without nulls; much faster than ``to_pylist``."""
    return texts.to_numpy(zero_copy_only=False).tolist()


#: First bytes of white space, and those that may begin a white space of several bytes.
_BLANK = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_MAYBE_BLANK = np.isin(np.arange(256), sorted({c.encode()[0] for c in map(chr, range(128, 0xD800)) if c.isspace()}))


def _blank_starts(words: pa.Array) -> np.ndarray:
    """Which of the words (large strings without nulls) are empty or begin with what ``str.isspace`` calls white space."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    blank = np.diff(offsets) == 0
    filled = np.flatnonzero(~blank)
    if len(filled):
        first = np.frombuffer(words.buffers()[2], np.uint8)[offsets[filled]]
        blank[filled] = _BLANK[first]
        for k in filled[_MAYBE_BLANK[first]].tolist():
            blank[k] = words[k].as_py()[0].isspace()
    return blank


def divided(texts: pa.Array, whole: Sequence[str] = (), places: re.Pattern = CUT) -> Divided:
    """Cuts texts into chunks. A null text is empty. A text that has one of ``whole`` in it is a single chunk.

    ``places`` finds the spaces to cut at in texts that have more than single spaces between words.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    cut = pc.split_pattern(texts, " ")
    numbered = cut.flatten().dictionary_encode()
    words = strings_of(numbered.dictionary)
    codes = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = cut.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = starts - starts[0]
    body = np.ones(len(codes), bool)
    body[starts[:-1]] = False
    odd = _blank_starts(numbered.dictionary)
    own = np.zeros(len(texts), bool)
    if odd.any():
        own[np.searchsorted(starts, np.flatnonzero(odd[codes] & body), side="right") - 1] = True
    for special in whole:
        own |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
    if own.any():
        body &= ~np.repeat(own, np.diff(starts))
    used = np.zeros(len(words), bool)
    used[codes[body]] = True
    number = np.cumsum(used) - 1
    bodies = [w for w, u in zip(words, used.tolist(), strict=True) if u]
    heads: dict[str, int] = {}
    lists = []
    for k in np.flatnonzero(own).tolist():
        text = texts[k].as_py()
        first, *rest = [text] if any(s in text for s in whole) else places.split(text)
        lists.append([heads.setdefault(c, len(heads)) for c in (first, *[f" {r}" for r in rest])])
    first_words = [words[c] for c in codes[starts[:-1]].tolist()]
    first_numbers = [-1 if o else heads.setdefault(w, len(heads)) for w, o in zip(first_words, own.tolist(), strict=True)]
    marked = number[codes] + len(heads)
    marked[starts[:-1]] = first_numbers
    if not lists:
        return Divided(list(heads), bodies, marked, starts)
    sizes = np.diff(starts)
    plain = np.repeat(~own, sizes)
    sizes[own] = [len(x) for x in lists]
    starts = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    codes = np.empty(starts[-1], np.int64)
    there = np.repeat(own, sizes)
    codes[there], codes[~there] = [c for x in lists for c in x], marked[plain]
    return Divided(list(heads), bodies, codes, starts)


class Ragged(NamedTuple):
    """Rows of different lengths: ``values[starts[k]:starts[k + 1]]`` is the k-th."""

    values: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of_bytes(rows: list[bytes]) -> Ragged:
        """From rows of little-endian unsigned 32-bit integers."""
        starts = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) >> 2, out=starts[1:])
        return Ragged(np.frombuffer(b"".join(rows), "<u4"), starts)

    def row(self, k: int) -> np.ndarray:
        return self.values[self.starts[k] : self.starts[k + 1]]

    def rows(self) -> list[bytes]:
        raw, ends = self.values.tobytes(), (self.values.itemsize * self.starts).tolist()
        return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def dealt(self, codes: np.ndarray) -> Ragged:
        """The rows with the numbers ``codes``, one after the other."""
        if not len(codes):
            return Ragged(self.values[:0], np.zeros(1, np.int64))
        values, size = np.ascontiguousarray(self.values), self.values.itemsize
        ends = np.ascontiguousarray(self.starts, np.int64) * size
        rows = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values)]).take(pa.array(codes))
        starts = np.frombuffer(rows.buffers()[1], np.int64)[: len(codes) + 1]
        raw = rows.buffers()[2]
        return Ragged(np.frombuffer(raw, values.dtype, starts[-1] // size) if starts[-1] else values[:0], starts // size)


class Generations:
    """Remembers what strings give: at most ``most`` in the younger generation, and the one before it."""

    def __init__(self, most: int) -> None:
        self.most, self.young, self.old = most, {}, {}

    def of(self, strings: list[str], make: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """What distinct ``strings`` give; ``make`` is asked for the new ones together."""
        found = list(map(self.young.get, strings))
        missing = [s for s, f in zip(strings, found, strict=True) if f is None]
        if not missing:
            return found
        if len(self.young) + len(missing) > self.most:
            self.young, self.old = {}, self.young
            missing = strings
        young = self.young
        if self.old:
            kept = list(map(self.old.get, missing))
            young.update((s, k) for s, k in zip(missing, kept, strict=True) if k is not None)
            missing = [s for s, k in zip(missing, kept, strict=True) if k is None]
        if missing:
            young.update(zip(missing, make(missing), strict=True))
        return list(map(young.__getitem__, strings))


class ChunkEncoder:
    """Ids of chunks: matches of ``pattern``, each encoded by ``encode_all``, which maps distinct strings to little-endian
    unsigned 32-bit ids. ``direct`` encodes a chunk that has one of ``whole`` in it."""

    def __init__(self, encode_all: Callable[[list[str]], list[bytes]], pattern: str = PATTERN, whole: Sequence[str] = (), direct: Callable[[str], bytes] | None = None, most: int = CACHE) -> None:
        self.encode_all, self.matches, self.whole_words = encode_all, regex.compile(pattern).findall, pattern == PATTERN
        self.whole, self.direct, self.pieces = tuple(whole), direct, Generations(most)

    def _matches(self, cut: Divided) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The matches in all chunks, where those of each begin, and the chunks' places in that order.

        By the usual pattern, bodies of ASCII letters are a match as they stand. The others are searched together: each begins at the next space.
        """
        parts = [self.matches(h) for h in cut.heads]
        starts = np.cumsum([0, *map(len, parts)])
        found, n = [piece for part in parts for piece in part], len(cut.heads)
        if not cut.bodies:
            return pa.array(found, pa.large_string()), starts, np.arange(n)
        bodies = pa.array(cut.bodies, pa.large_string())
        plain = pc.and_(pc.ascii_is_alpha(bodies), self.whole_words)
        single, rest = bodies.filter(plain), bodies.filter(pc.invert(plain)).to_pylist()
        single = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), single, pa.scalar(" ", pa.large_string()))
        searched = pa.array(self.matches(f" {' '.join(rest)}") if rest else [], pa.large_string())
        leads = np.flatnonzero(pc.starts_with(searched, " ").to_numpy(zero_copy_only=False))
        if len(leads) != len(rest):
            raise ValueError("the pattern does not begin a match at every space before something else")
        pieces = pa.concat_arrays([pa.array(found, pa.large_string()), single, searched])
        ends = starts[-1] + np.arange(len(single)), starts[-1] + len(single) + leads
        letters = plain.to_numpy(zero_copy_only=False)
        places = n + np.where(letters, np.cumsum(letters) - 1, len(single) + np.cumsum(~letters) - 1)
        return pieces, np.concatenate([starts[:-1], *ends, [len(pieces)]]), np.concatenate([np.arange(n), places])

    def of_distinct(self, cut: Divided) -> Ragged:
        """Ids of the distinct chunks of ``cut``."""
        if any(w in h for w in self.whole for h in cut.heads):
            plain = self.of_distinct(cut._replace(heads=["" if any(w in h for w in self.whole) else h for h in cut.heads]))
            raw = [np.frombuffer(self.direct(h), "<u4") if any(w in h for w in self.whole) else plain.row(k) for k, h in enumerate(cut.heads)]
            at = plain.starts[len(cut.heads) :]
            starts = np.cumsum([0, *map(len, raw)])
            return Ragged(np.concatenate([*raw, plain.values[at[0] :]]), np.concatenate([starts[:-1], at - at[0] + starts[-1]]))
        found, starts, places = self._matches(cut)
        numbered = found.dictionary_encode()
        ids = Ragged.of_bytes(self.pieces.of(strings_of(numbered.dictionary), self.encode_all))
        dealt = ids.dealt(numbered.indices.to_numpy(zero_copy_only=False))
        return Ragged(dealt.values, dealt.starts[starts]).dealt(places)

    def __call__(self, texts: pa.Array) -> Ragged:
        """Ids of whole texts."""
        cut = divided(texts, self.whole)
        ids = self.of_distinct(cut).dealt(cut.codes)
        return Ragged(ids.values, ids.starts[cut.starts])

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self(pa.array(texts, pa.large_string())).rows()


def with_end(ids: Ragged, end: int) -> Ragged:
    """Every row with ``end`` after it."""
    n = len(ids.starts) - 1
    starts = ids.starts + np.arange(n + 1)
    values = np.empty(len(ids.values) + n, "<u4")
    last = np.zeros(len(values), bool)
    last[starts[1:] - 1] = True
    values[last], values[~last] = end, ids.values
    return Ragged(values, starts)


def process_wide(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, once in the life of a Python worker, so that its tasks share what they have learned."""
    held = sys.__dict__.setdefault("_training_text_caches", {})
    if key not in held:
        held[key] = make()
    return held[key]


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell each byte: printable Latin-1 by itself, all others by letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def encoder(path: str, specials: bool = True, most: int = CACHE) -> ChunkEncoder:
    """An encoder by the tokenizers library, without added tokens.

    ``specials`` is the library's default: the strings of special tokens become their ids. Without it they are ordinary text.
    """
    return process_wide(("tokenizers", path, specials, most), lambda: _encoder(path, specials, most))


def _encoder(path: str, specials: bool, most: int) -> ChunkEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters, model = byte_letters(), tokenizer.model
    one = np.arange(tokenizer.get_vocab_size(), dtype="<u4").tobytes()
    four = [one[4 * k : 4 * k + 4] for k in range(len(one) // 4)]

    def encode_all(pieces: list[str]) -> list[bytes]:
        spelled = "\0".join(pieces).encode().decode("latin-1").translate(joined).split("\0")
        if len(spelled) != len(pieces):
            spelled = [p.encode().decode("latin-1").translate(letters) for p in pieces]
        return [b"".join([four[t.id] for t in model.tokenize(s)]) for s in spelled]

    joined = {b: c for b, c in letters.items() if b}
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if specials else []

    def direct(text: str) -> bytes:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return ChunkEncoder(encode_all, whole=added, direct=direct, most=most)
