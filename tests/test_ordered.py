"""Order-sensitive rewrites against plain loops, with spans small enough to cross borders."""

import random

import pytest
from pyspark.sql import functions as F

from slipstream.operators import ordered

ORDER = ["block_no", "line_no"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    made = []
    for session in ("hot", "cold", "empty"):
        for block in (0, 4096):
            for line in range(150 if session == "hot" else 20):
                value = None if session == "empty" or rng.random() < 0.8 else rng.randrange(1000)
                made.append((session, rng.choice(["1", "2", None]), block, line, value))
    return made


SCHEMA = "session_id string, car string, block_no long, line_no long, value int"


@pytest.mark.parametrize("span", [1, 7, 65_536])
@pytest.mark.parametrize("keys", [["session_id"], ["session_id", "car"]])
def test_fill_forward(spark, rows, span, keys):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ordered.fill_forward(df, keys, F.col("value"), "value", ORDER, span_lines=span)
    seen, want = {}, []
    for s, c, b, n, v in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        key = (s, c) if "car" in keys else s
        seen[key] = v if v is not None else seen.get(key)
        want.append((s, c, b, n, seen[key]))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_patch_back(spark):
    rng = random.Random(3)
    made = [("s", rng.choice([1, 2, 3]), 0, i, rng.random() < 0.3, rng.choice([None, i])) for i in range(300)]
    df = spark.createDataFrame(made, "session_id string, car int, block_no long, line_no long, ins boolean, at int").repartition(4)
    got = ordered.patch_back(df, ["session_id", "car"], "at", "ins", ORDER)
    kept = []
    for s, c, b, n, ins, at in made:
        if ins:
            kept.append([s, c, b, n, at])
            continue
        for row in reversed(kept):
            if row[1] == c:
                row[4] = at
                break
    assert sorted(map(tuple, got.select("session_id", "car", "block_no", "line_no", "at").collect()), key=repr) == sorted(map(tuple, kept), key=repr)


def test_last_per_key_and_first_entry(spark, raw):
    df = raw((5, "a"), (5, "b"), (6, "c"))
    last = ordered.last_per_key(df, ["session_id", "timestamp_ms"], ["block_no", "line_no", "entry_no"])
    assert sorted((r.timestamp_ms, r.payload) for r in last.collect()) == [(5, "b"), (6, "c")]
    assert [r.payload for r in ordered.first_entry(df).collect()] == ["a"]


def test_last_per_key_after_first_entry(spark, raw):
    df = raw((5, "a"), (5, "b"), (6, "c"), (6, "d")).unionByName(raw((9, "x"), (9, "y"), (9, "z"), session="2024/a/c")).unionByName(raw((9, "only"), session="2024/a/d"))
    got = ordered.last_per_key_after_first_entry(df.repartition(3), ["session_id", "timestamp_ms"], ["block_no", "line_no", "entry_no"])
    assert got.columns == df.columns
    assert sorted((r.timestamp_ms, r.payload) for r in got.collect()) == [(5, "b"), (6, "d"), (9, "z")]
