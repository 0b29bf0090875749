import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from slipstream.llm import bpe_fst, subword
from tests.llm.conftest import pairs, same

PATH = subword.public_path(bpe_fst.RANKS)


@pytest.fixture(scope="module")
def ranks():
    return bpe_fst.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merges(ranks):
    return bpe_fst.Merges(ranks)


@pytest.mark.parametrize("most", [50, 100_000])
def test_pieces_against_the_library(ranks, merges, library, most):
    rng = random.Random(most)
    tokens = list(ranks)
    pieces = [b"".join(rng.choices(tokens, k=rng.randint(1, 5))) for _ in range(1500)]
    pieces += [bytes(rng.choices(b"abe nthing", k=rng.randint(1, 120))) for _ in range(300)]
    pieces += [b"", b"a" * 300, b" " * 200, b"=" * 500, bytes(range(256)), "漢字🙂é".encode()]
    own = bpe_fst.Transducer(merges, most)
    for _ in range(3):  # simulated, then determinised, then followed
        for piece in pieces:
            assert own(piece) == (library._encode_single_piece(piece) if piece else [])


@pytest.mark.parametrize("often,most", [(1, 100_000), (3, 60), (10**9, 100_000)])
def test_pieces_together_against_the_library(ranks, merges, library, often, most, monkeypatch):
    monkeypatch.setattr(bpe_fst, "OFTEN", often)
    rng = random.Random(often)
    tokens = list(ranks)
    pieces = {b"".join(rng.choices(tokens, k=rng.randint(1, 5))) for _ in range(2000)}
    pieces |= {bytes(rng.choices(b"abe nthing", k=rng.randint(1, 120))) for _ in range(400)}
    pieces |= {b"", b"a", b"a" * 300, b" " * 60, b"=" * 64, b"=" * 65, bytes(range(64)), "漢字🙂é".encode()}
    pieces = sorted(pieces)
    own = bpe_fst.Together(merges, most)
    for _ in range(2):
        assert [list(memoryview(x).cast("I")) for x in own(pieces)] == [library._encode_single_piece(p) if p else [] for p in pieces]


def test_a_pattern_that_reaches_over_spaces_is_refused():
    with pytest.raises(ValueError, match="does not begin a match"):
        bpe_fst.encoder(PATH, r"[^\n]+|\n")(pa.array(["a b c"]))


def test_another_pattern(ranks):
    other = r"[a-z]+|[^a-z]"
    library = tiktoken.Encoding("other", pat_str=other, mergeable_ranks=ranks, special_tokens={})
    texts = ["a b c", "these, and those 12 Words\n more ", "", "  x"]
    assert [x.tolist() for x in map(bpe_fst.encoder(PATH, other)(pa.array(texts)).row, range(4))] == [library.encode_ordinary(t) for t in texts]


def test_tokens_come_out_before_the_end(merges):
    """After a piece was determinised, most of its tokens are emitted on the way."""
    own = bpe_fst.Transducer(merges)
    piece = b"thereisnothingtobesaidaboutthat" * 5
    for _ in range(400):
        tokens = own(piece)
    at, early = 0, 0
    for byte in piece:
        emitted, at = own.step[at << 8 | byte]
        early += len(emitted)
    assert early >= 0.9 * len(tokens)


def test_streaming_decode(ranks, library):
    bytes_of = {v: k for k, v in ranks.items()}
    text = "Ünïcode 漢字 🙂🙂 ẞ, plain"
    ids = library.encode_ordinary(text)
    parts = list(bpe_fst.decode_stream(ids, bytes_of))
    assert "".join(parts) == text and len(parts) > 3
    assert "".join(bpe_fst.decode_stream([ranks[b"\xf0"], ranks[b"a"], ranks[b"\xe6"]], bytes_of)) == "�a�"


@pytest.mark.parametrize("which", ["odd", "small"])
def test_tables(which, library, request):
    docs = request.getfixturevalue(which)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in pairs(docs):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode()), t or ""))
    ids = bpe_fst.encoded(docs, PATH, public_tokenizers.PATTERN)
    got = bpe_fst.decoded(ids, PATH)
    same(got.collect(), want)
    same(bpe_fst.round_trip(docs, PATH, public_tokenizers.PATTERN).collect(), [w[:4] for w in want])


def test_empty_table_and_null_ids(spark, table):
    assert bpe_fst.decoded(bpe_fst.encoded(table([]), PATH, public_tokenizers.PATTERN), PATH).count() == 0
    row = bpe_fst.decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), PATH).first()
    assert (row["n_tokens"], row["text"]) == (0, "")
