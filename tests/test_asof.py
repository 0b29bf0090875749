"""As-of join against a loop over all pairs, with hot keys, copies, gaps, null keys and every strategy."""

import random

import pytest

from slipstream.operators import asof
from slipstream.operators.asof import asof_join

LEFT = "session_id string, racing_number int, block_no long, line_no long, entry_no int, key_pos int, timestamp_ms long, speed int, utc string"
RIGHT = "session_id string, racing_number int, block_no long, line_no long, entry_no int, key_pos int, timestamp_ms long, x int, utc string"


def make(seed, n, spread):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        car = 1 if rng.random() < 0.5 else rng.choice([2, 3, None])
        ms = rng.choice([100, 5000]) if rng.random() < 0.3 else rng.randrange(spread)
        rows.append((rng.choice(["a", "b"]), car, 0, i, 0, 0, ms, rng.randrange(100), f"u{i}"))
    return rows


def brute(left, right, strategy, tolerance):
    out = []
    for l in left:
        best = None
        for r in right:
            if l[1] is None or (l[0], l[1]) != (r[0], r[1]):
                continue
            gap = r[6] - l[6]
            if (strategy == "backward" and gap > 0) or (strategy == "forward" and gap < 0):
                continue
            if tolerance is not None and abs(gap) > tolerance:
                continue
            rank = (-abs(gap), -r[6], r[3])
            if best is None or rank > best[0]:
                best = (rank, r)
        out.append((*l, *(best[1][7:] if best else (None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strategy", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("ranges,tolerance", [(20, None), (90, 300), (1, None), (None, None), (0, None)])
def test_against_all_pairs(spark, strategy, ranges, tolerance):
    left, right = make(1, 400, 20_000), make(2, 150, 12_000)
    got = asof_join(
        spark.createDataFrame(left, LEFT).repartition(3),
        spark.createDataFrame(right, RIGHT).repartition(3),
        strategy=strategy,
        tolerance=tolerance,
        ranges=ranges,
    )
    assert got.columns[-2:] == ["x", "utc_right"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(left, right, strategy, tolerance)


def test_no_right_rows(spark):
    left = make(1, 20, 1000)
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame([], RIGHT))
    assert sorted((r.line_no, r.x) for r in got.collect()) == [(i, None) for i in range(20)]


def test_unknown_strategy(spark):
    empty = spark.createDataFrame([], RIGHT)
    with pytest.raises(ValueError, match="strategy"):
        asof_join(empty, empty, strategy="sideways")


@pytest.mark.parametrize("strategy", ["nearest", "backward", "forward"])
def test_one_clock_with_most_rows(spark, strategy):
    left, right = make(3, 300, 9000), make(4, 100, 9000)
    left = [(*r[:6], 4200 + r[3] % 3 if r[3] % 4 else r[6], *r[7:]) for r in left]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), strategy=strategy, ranges=40)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(left, right, strategy, None)


def test_rows_without_a_clock_match_nothing(spark):
    left = [("a", 1, 0, i, 0, 0, None if i % 2 else 50 * i, 1, "u") for i in range(40)]
    right = [("a", 1, 0, i, 0, 0, 10 * i, i, "r") for i in range(100)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ranges=7)
    assert sorted((r.line_no, r.x) for r in got.collect()) == [(i, None if i % 2 else min(5 * i, 99)) for i in range(40)]


def test_each_side_is_read_once(spark, tmp_path):
    for name, schema, rows in (("l", LEFT, make(1, 50, 900)), ("r", RIGHT, make(2, 50, 900))):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    joined = asof_join(spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r")))
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 2 and "ReusedExchange" in plan


def test_a_hot_span_is_dealt_over_many_ranges(spark):
    """Nine rows of ten within five seconds of one key, half of those at one clock: no range has much more than its share."""
    rows = [("a", 1, 0, i, 0, 0, (7000 if i % 2 else 5000 + i % 5000) if i % 10 else i * 37, 1, "u") for i in range(40_000)]
    left, right = spark.createDataFrame(rows[::2], LEFT), spark.createDataFrame(rows[1::2], RIGHT)
    both = asof._tagged(left, right, "timestamp_ms", ["session_id", "racing_number"], ["x", "utc"], asof.PLACE)
    where = both.select("_by0", "_by1", "_at", "_is_left", "_place")
    sizes = [r["count"] for r in both.groupBy(asof._range_of(where, 20).alias("r")).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2 * sorted(sizes)[10]


def test_needs_a_key(spark):
    empty = spark.createDataFrame([], RIGHT)
    with pytest.raises(ValueError, match="key"):
        asof_join(empty, empty, by=[])
