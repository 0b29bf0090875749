import bisect
import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from slipstream.llm import alignment, subword
from tests.llm.conftest import pairs, same

A, B = subword.public_path(subword.VOCABULARY), subword.public_path(alignment.PIECES)


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: k for k, c in subword.byte_letters().items()}
    bytes_a = lambda t: bytes(byte_of[c] for c in a.id_to_token(t))
    return a, b, bytes_a, lambda t: alignment.piece_bytes(b.id_to_piece(t))


def brute(rows, tokenizers):
    a, b, bytes_a, bytes_b = tokenizers
    found, counts = [], Counter()
    for i, text in rows:
        groups = []
        if text:
            x, y = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
            if b"".join(map(bytes_a, x)) == b"".join(map(bytes_b, y)) == f" {text}".encode():
                ends = []
                for ids, of in ((x, bytes_a), (y, bytes_b)):
                    at, own = 0, {}
                    for t in ids:
                        at += len(of(t))
                        own[at] = t
                    ends.append(own)
                links = [(ends[0][e], ends[1][e]) for e in sorted(ends[0].keys() & ends[1].keys())]
                cuts = sorted(ends[0].keys() & ends[1].keys())
                sides = []
                for own in ends:
                    parts = {c: [] for c in cuts}
                    for e in sorted(own):
                        parts[cuts[bisect.bisect_left(cuts, e)]].append(own[e])
                    sides.append(parts)
                groups = [(sides[0][c], sides[1][c]) for c in cuts]
                counts.update(links)
                found.append((i, x, y, groups, links))
                continue
        found.append((i, [], [], [], []))
    best = Counter()
    for (_, q), n in counts.items():
        best[q] = max(best[q], n)
    out = []
    for i, x, y, groups, links in found:
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if groups else ""
        out.append((i, len(x), len(y), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), digest))
    return out


MORE = [(70, " two  spaces   here "), (71, "a ▁ mark"), (72, "<s> </s> <|endoftext|> <unk>"), (73, " "), (74, "x\n y \n\n  z q"), (75, "　wide  　"), (76, "a\0b \0 c"), (77, "\t tab")]


@pytest.mark.parametrize("which,most", [("odd", 0), ("small", 50), ("odd", 1 << 18)])
def test_tables(which, most, tokenizers, request):
    docs = request.getfixturevalue(which)
    same(alignment.aligned(docs, A, B, most=most).collect(), brute(pairs(docs), tokenizers))


def test_odd_spaces_marks_and_special_strings(table, tokenizers):
    got = alignment.aligned(table(MORE), A, B).collect()
    same(got, brute(MORE, tokenizers))
    assert next(r for r in got if r["doc_id"] == 71)["n_a"] == 0


def test_empty_table(table):
    assert alignment.aligned(table([]), A, B).count() == 0


def test_identity_takes_tokens_of_the_same_bytes():
    assert alignment.identity([b"a", b"bc", b""], [b"x", b"a", b"a"]).tolist() == [2, -1, -1]
    assert alignment.piece_bytes("▁▁a") == b"  a" and alignment.piece_bytes("<0xE2>") == b"\xe2"
