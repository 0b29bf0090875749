import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from slipstream.llm import packing, subword
from tests.llm.conftest import pairs

PATH = subword.public_path(subword.VOCABULARY)


def check(docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    got = packing.packed(docs, PATH, capacity).collect()
    want, tokens = [], 0
    for i, text in pairs(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        tokens += len(ids)
        rest = len(ids) % capacity
        starts = ([0] if rest else []) + list(range(rest, len(ids), capacity))
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    order = lambda r: [(x is not None, x) for x in r]
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-tokens // capacity)


def test_odd_rows(odd):
    used, least = check(odd, 1024)
    assert used <= least + 1


def test_small_table(small):
    used, least = check(small, 1024)
    assert used <= 1.03 * least


def test_empty_table(table):
    assert packing.packed(table([]), PATH).count() == 0


def test_plan_uses_every_piece_once_and_fills_bins():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 100, 1024):
        counts = {int(x): int(n) for x, n in zip(rng.integers(1, capacity + 1, 300), rng.integers(1, 9, 300), strict=True)}
        plan = packing.plan(dict(counts), capacity)
        used = {}
        for times, combination in plan:
            assert sum(x * n for x, n in combination.items()) <= capacity
            for x, n in combination.items():
                used[x] = used.get(x, 0) + times * n
        assert used == counts


def test_fullest_is_best():
    rng = np.random.default_rng(3)
    for _ in range(200):
        counts = {int(x): int(n) for x, n in zip(rng.integers(1, 20, 4), rng.integers(1, 4, 4), strict=True)}
        room = int(rng.integers(0, 40))
        reach = {0}
        for x, n in counts.items():
            reach = {r + x * k for r in reach for k in range(n + 1) if r + x * k <= room}
        chosen = packing.fullest(counts, room)
        assert sum(x * n for x, n in chosen.items()) == max(reach)
        assert all(n <= counts[x] for x, n in chosen.items())


TEXTS = ["", " ", "a  b \n c", "x \x1cy   z", "tab\t x trail ", "don't  's <|endoftext|> q", "many words here that do not fit at all", "  lead", "a\0b \0 c", "<|endoftext|>"]


@pytest.mark.parametrize("plain", [False, True])
def test_encoder_agrees_with_the_library(plain):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = plain
    own = subword.encoder(PATH, specials=not plain)
    tiny = subword.ChunkEncoder(own.encode_all, whole=own.whole, direct=own.direct, most=5)
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in tiny.many(TEXTS)] == want
    assert [np.frombuffer(tiny.many([t])[0], "<u4").tolist() for t in TEXTS] == want


def test_special_tokens_in_a_text_are_those_of_the_default_call(table):
    check(table([(1, "a <|endoftext|> b"), (2, "<|endoftext|><|endoftext|>"), (3, "a b")]), 4)
