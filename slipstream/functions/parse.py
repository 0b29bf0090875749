"""Text-to-value column expressions. Everything here is built-in Spark, so it stays in the JVM.

Feeds are loosely typed: a number may arrive as ``44`` or ``"44"`` and an unknown value as ``""``.
Hence every cast is a ``try_cast`` and a value that does not fit becomes null.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feed formats.
CLOCK_TEXT = r"^\d+:\d+:\d+\.\d+$"
LAP_TEXT = r"^(?:(\d+):)?(\d+)\.(\d+)$"
RACE_LEADER_LAP = r"^LAP\s+(\d+)$"
RACE_LAPPED = r"^\+(\d+)\s+LAP$"
RACE_TIME_GAP = r"^\+(?:(\d+):)?(\d+\.\d+)$"
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_LEAD = r"^\d{4}-\d{2}-\d{2}"

CATCHING = {1: "not_closing", 2: "closing"}
OVERTAKE_STATE = {0: "lost_position", 1: "neutral", 2: "gained_position"}
SAFETY_CAR_ALIASES = {"VSC": "VIRTUAL SAFETY CAR", "SC": "SAFETY CAR"}
COMPOUNDS = ["HARD", "MEDIUM", "SOFT", "INTERMEDIATE", "WET", "UNKNOWN"]


def _big(c: Column) -> Column:
    return c.try_cast("bigint")


def clock_ms(c: Column) -> Column:
    """``H:M:S.ms`` to milliseconds; the part after the point counts as written. Other text gives null."""
    last = F.substring_index(c, ":", -1)
    return F.when(
        c.rlike(CLOCK_TEXT),
        _big(F.substring_index(c, ":", 1)) * 3_600_000
        + _big(F.substring_index(F.substring_index(c, ":", 2), ":", -1)) * 60_000
        + _big(F.substring_index(last, ".", 1)) * 1_000
        + _big(F.substring_index(last, ".", -1)),
    )


def utc(c: Column) -> Column:
    """ISO text to a UTC timestamp without zone; digits past the microsecond are cut."""
    return F.when(c.rlike(DATE_LEAD), c.try_cast("timestamp_ntz"))


def utc_ms(c: Column) -> Column:
    """As :func:`utc`, cut to milliseconds."""
    return F.date_trunc("MILLISECOND", utc(c)).cast("timestamp_ntz")


def lap_ms(c: Column) -> Column:
    """``(M:)?S.f`` to milliseconds; empty or odd text gives null."""
    minutes = F.coalesce(_big(F.regexp_extract(c, LAP_TEXT, 1)), F.lit(0))
    seconds = _big(F.regexp_extract(c, LAP_TEXT, 2))
    millis = _big(F.rpad(F.regexp_extract(c, LAP_TEXT, 3), 3, "0"))
    return F.when(c.rlike(LAP_TEXT), minutes * 60_000 + seconds * 1_000 + millis)


def keyframe_lap_ms(c: Column) -> Column:
    """As :func:`lap_ms`, but empty text is zero. Odd text is null here and counted by the quality report."""
    return F.when(c == "", F.lit(0).cast("bigint")).otherwise(lap_ms(c))


def number(c: Column) -> Column:
    return F.when(c.rlike(PLAIN_NUMBER), c.try_cast("double"))


def gap(c: Column) -> Column:
    """Gap text to a number: ``+1.5`` is seconds, ``2L`` is minus two laps, anything else null."""
    bare = F.ltrim(c, F.lit("+"))
    laps = F.substring(bare, F.lit(1), F.length(bare) - 1).try_cast("int")
    return F.when(F.endswith(bare, F.lit("L")), (-laps).cast("double")).otherwise(number(bare))


def _minutes_seconds(c: Column) -> Column:
    minutes = F.coalesce(F.regexp_extract(c, RACE_TIME_GAP, 1).try_cast("int"), F.lit(0))
    return minutes * F.lit(60.0) + F.regexp_extract(c, RACE_TIME_GAP, 2).try_cast("double")


def race_gap(c: Column) -> Column:
    """Race gap text to ``struct(gap_seconds, laps_behind, is_leader, leader_lap)``."""
    leads = F.coalesce(c.rlike(RACE_LEADER_LAP), F.lit(False))
    return F.struct(
        F.when(c.rlike(RACE_TIME_GAP), _minutes_seconds(c)).alias("gap_seconds"),
        F.coalesce(F.regexp_extract(c, RACE_LAPPED, 1).try_cast("int"), F.lit(0)).alias("laps_behind"),
        leads.alias("is_leader"),
        F.when(leads, F.regexp_extract(c, RACE_LEADER_LAP, 1).try_cast("int")).alias("leader_lap"),
    )


def interval_seconds(c: Column) -> Column:
    return F.when(c.rlike(RACE_TIME_GAP), _minutes_seconds(c))


def code_name(c: Column, names: dict[int, str]) -> Column:
    """Integer code to its name; a code without a name gives null."""
    code = c.try_cast("int")
    first, *rest = names.items()
    start = F.when(code == first[0], F.lit(first[1]))
    return reduce(lambda acc, kv: acc.when(code == kv[0], F.lit(kv[1])), rest, start)


def remaining_ms(c: Column) -> Column:
    hms = F.split(c, ":")
    return (
        _big(F.get(hms, F.lit(0))) * 3_600_000
        + _big(F.get(hms, F.lit(1))) * 60_000
        + _big(F.get(hms, F.lit(2))) * 1_000
    )


def gmt_offset_s(c: Column) -> Column:
    hms = F.split(F.ltrim(c, F.lit("-")), ":")
    size = (
        F.get(hms, F.lit(0)).try_cast("int") * 3600
        + F.get(hms, F.lit(1)).try_cast("int") * 60
        + F.get(hms, F.lit(2)).try_cast("int")
    )
    return F.when(F.startswith(c, F.lit("-")), -size).otherwise(size)


def safety_car_mode(c: Column) -> Column:
    text = F.upper(F.trim(c))
    return reduce(
        lambda acc, kv: F.when(text == kv[0], F.lit(kv[1])).otherwise(acc),
        SAFETY_CAR_ALIASES.items(),
        text,
    )


def compound(c: Column) -> Column:
    return F.when(c.isin(COMPOUNDS), c).otherwise(F.lit("UNKNOWN"))


def folded(c: Column) -> Column:
    return F.lower(F.trim(c))


def contains_folded(haystack: Column, folded_needle: Column) -> Column:
    return F.coalesce(F.contains(F.lower(haystack), folded_needle), F.lit(False))


def clock_seconds(c: Column) -> Column:
    """Whole seconds of a millisecond clock."""
    return F.floor(c / 1000)
