import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from slipstream.llm import subword, wavelet
from slipstream.llm.staging import new_folder
from tests.llm.conftest import pairs

PATH = subword.public_path(subword.VOCABULARY)


@pytest.mark.parametrize("high", [1, 2, 7, 300, 70_000])
@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_matrix_against_the_array(n, high):
    rng = np.random.default_rng(n + high)
    s = rng.integers(0, high, n)
    m = wavelet.WaveletMatrix.build(s)
    m = wavelet.WaveletMatrix(m.n, m.width, *m.parts(), m.zeros)
    assert (m.symbols() == s).all()
    assert (m.access(np.arange(n)) == s).all()
    for c in {int(x) for x in s[:3]} | {0, high + 5}:
        where = np.flatnonzero(s == c)
        for end in (0, n // 3, n):
            assert m.rank(c, end) == (where < end).sum()
        if len(where):
            assert (m.select(c, np.arange(len(where))) == where).all()


def encoded(docs):
    tokenizer = Tokenizer.from_file(PATH)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in pairs(docs)]


def shards(spark, docs, **options):
    path = new_folder(spark, "shards")
    wavelet.write(docs, path, PATH, **options)
    return wavelet.read(spark, path)


@pytest.mark.parametrize("bits,most", [(12, 1 << 24), (2, 1 << 24), (12, 500)])
def test_round_trip(spark, odd, bits, most, monkeypatch):
    monkeypatch.setattr(wavelet, "MOST_TOKENS", most)
    made = shards(spark, odd, shard_bits=bits)
    got = sorted((r["start"], r["n_tokens"], r["ids_crc32"], r["doc_id"]) for r in wavelet.documents(made).collect())
    assert [s for s, *_ in got] == np.cumsum([0, *[n for _, n, *_ in got[:-1]]]).tolist()
    ids = [i for *_, i in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted((i is not None, i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in encoded(odd))
    assert sorted((i is not None, i or 0, n, crc) for _, n, crc, i in got) == want


def test_one_file_for_each_shard(spark, small):
    made = shards(spark, small, shard_bits=6)
    assert len(made.inputFiles()) == made.count() == len({i >> 6 for i, _ in pairs(small)})


def test_lookup_and_counting(spark, small):
    made = shards(spark, small, shard_bits=6)
    texts = encoded(small)
    for token in (0, 262, 13, 49_999):
        want = sorted((i, k) for i, ids in texts for k, x in enumerate(ids) if x == token)
        assert sorted(tuple(r) for r in wavelet.occurrences(made, token).collect()) == want
        assert sum(r["times"] for r in wavelet.counted(made, token).collect()) == len(want)


def test_empty_table(spark, table):
    made = shards(spark, table([]))
    assert made.count() == 0 and wavelet.documents(made).count() == 0


def test_known_strings_are_not_asked_again():
    asked = []
    known = subword.Generations(4)
    for strings in (["a", "b", "c"], ["d"], ["a", "b"], ["a", "b", "c"], ["d", "e"], ["e", "a"]):
        assert known.of(strings, lambda new: asked.extend(new) or [s.encode() for s in new]) == [s.encode() for s in strings]
    assert asked == ["a", "b", "c", "d", "e"]


def test_plain_words_are_not_searched():
    searched = []
    encode = subword.encoder(PATH, most=1000)
    matches, encode.matches = encode.matches, lambda text: searched.append(text) or matches(text)
    texts = ["plain words, é x1 don't\n\nIt's  two \x85next  wide  \t", "", None, "ab", " ab ", "a\x00b c\x00 d", "ab <|endoftext|> cd ef", "plainly " * 20 + "漢字 Ünï"]
    tokenizer = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode.many(texts)] == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not any(" plainly" in t for t in searched)
