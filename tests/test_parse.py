"""Text-to-value rules on the values the feeds are known to hold, and on ones that must give null."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slipstream.functions import parse
from slipstream.sources.index import session_name


def values(spark, rule, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.v for r in rows.select("i", rule(F.col("t")).alias("v")).orderBy("i").collect()]


CASES = [
    (parse.clock_ms, {"00:00:01.000": 1000, "1:02:03.045": 3723045, "00:00:00.5": 5, "00:00:01": None, "x": None, None: None}),
    (parse.lap_ms, {"1:26.933": 86933, "26.933": 26933, "26.9": 26900, "26.93345": 26933, "": None, "26": None, "x": None, None: None}),
    (parse.keyframe_lap_ms, {"": 0, "1:00.000": 60000, "x": None, None: None}),
    (parse.gap, {"+17.993": 17.993, "17": 17.0, "1L": -1.0, "+2L": -2.0, "0L": 0.0, "L": None, "xL": None, "": None, "LAP 3": None, "1d": None, None: None}),
    (parse.interval_seconds, {"+1.5": 1.5, "+1:02.345": 62.345, "LAP 3": None, "+1 LAP": None, "1.5": None, "": None}),
    (parse.remaining_ms, {"01:30:05": 5405000, "x": None, None: None}),
    (parse.gmt_offset_s, {"03:00:00": 10800, "-05:30:00": -19800, None: None}),
    (parse.safety_car_mode, {" vsc ": "VIRTUAL SAFETY CAR", "SC": "SAFETY CAR", "Safety Car": "SAFETY CAR", "x": "X", None: None}),
    (parse.compound, {"SOFT": "SOFT", "HYPERSOFT": "UNKNOWN", None: "UNKNOWN"}),
    (session_name, {"sprint qualifying": "Sprint Shootout", " Day 2 ": "Practice 2", "PRACTICE": "Practice 1", "race": "Race", "Warm-Up": None, None: None}),
]


@pytest.mark.parametrize("rule,cases", CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_rule(spark, rule, cases):
    assert values(spark, rule, list(cases)) == list(cases.values())


def test_utc_cuts_to_microseconds(spark):
    texts = ["2023-11-26T13:03:33.1234567Z", "2023-11-26T13:03:33.12Z", "2023-11-26T13:03:33Z", "2023-11-26T13:03:33", "44", ""]
    base = dt.datetime(2023, 11, 26, 13, 3, 33)
    assert values(spark, parse.utc, texts) == [
        base.replace(microsecond=123456), base.replace(microsecond=120000), base, base, None, None,
    ]
    assert values(spark, parse.utc_ms, texts[:1]) == [base.replace(microsecond=123000)]


def test_race_gap(spark):
    texts = ["LAP 12", "+1 LAP", "+1:02.345", "+0.5", "", None, "x"]
    assert [tuple(r) for r in values(spark, parse.race_gap, texts)] == [
        (None, 0, True, 12), (None, 1, False, None), (62.345, 0, False, None), (0.5, 0, False, None),
        (None, 0, False, None), (None, 0, False, None), (None, 0, False, None),
    ]


def test_code_names(spark):
    assert values(spark, lambda c: parse.code_name(c, parse.CATCHING), ["1", "2", "3", None]) == ["not_closing", "closing", None, None]
