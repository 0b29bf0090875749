import random
import re
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept string, score string, fp string, node string, spans string, shard string, length string, vector string, bucket string, hash string, copy string"
)
SPACE = r"[\x20\x09-\x0D]"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def odd_rows():
    """Ids and texts: null, empty, blank, repeated, copied, nearly copied, shared passages, very long, many-byte."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    a, passage = make(300), make(70)
    lines = "\n".join(make(12).capitalize() + "." for _ in range(30))
    near = a.split(" ")
    near[150] = "changed"
    run = "na " * 400
    return [
        (1, ""), (2, None), (None, "a text without an id"), (None, a), (3, a), (3, a), (4, a), (5, " ".join(near)), (6, "one"), (7, " \n\t \r"),
        (8, "Ünïcode 漢字 🙂🙂 ẞ don't 's 12   x"), (9, make(40) + "\n" + passage + " " + make(10)), (10, make(5) + "  " + passage.replace(" ", "\n") + make(33)),
        (11, lines), (12, "\n".join(reversed(lines.split("\n")))), (13, run), (14, "x " + run), (15, make(60000)), (16, passage), (17, "<|endoftext|> !! !! ## $$ | |"),
        (18, "x"), (18, "y z"), (-5, "a negative id"), (1 << 40, make(51)), (20, a + " " + a),
    ]


@pytest.fixture(scope="session")
def table(spark):
    """A table of documents with further columns whose names clash with those that operators use; null in all of them."""

    def build(rows):
        return spark.createDataFrame([(i, t, *[None] * 14) for i, t in rows], SCHEMA).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(table):
    return table(odd_rows())


@pytest.fixture(scope="session")
def small(spark):
    if not Path(SF_DIR).exists():
        pytest.skip("check tables not mounted")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    if not Path(SF_DIR).exists():
        pytest.skip("check tables not mounted")
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def rows(frame, *columns):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: [(x is not None, x) for x in r])


def same(got, want):
    order = lambda r: [(x is not None, x) for x in r]
    assert sorted(map(tuple, got), key=order) == sorted(map(tuple, want), key=order)
