"""Validation report: how many values break each rule, per session.

Rules cover types (a value is there but does not fit its column) and fixed vocabularies. Feeds and
keyframes keep such rows with a null or the raw value; this report counts them.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from slipstream.functions import parse
from slipstream.functions.jsonwalk import explode_object_items, parsed
from slipstream.sources import archive
from slipstream.sources.index import SESSION_NAMES, session_name

# Vocabularies of the feeds.
FLAGS = [
    "BLUE", "YELLOW", "DOUBLE YELLOW", "RED", "GREEN", "CLEAR", "CHEQUERED", "BLACK AND WHITE", "BLACK AND ORANGE",
]
SCOPES = ["Driver", "Sector", "Track"]
SAFETY_CAR_STATUS = ["DEPLOYED", "ENDING", "IN THIS LAP"]
SAFETY_CAR_MODES = ["SAFETY CAR", "VIRTUAL SAFETY CAR"]
DRS_STATUS = ["DISABLED", "ENABLED"]
CATEGORIES = ["Flag", "SafetyCar", "Drs", "Other"]
SESSION_TYPES = ["Practice", "Qualifying", "Race"]


def _outside(value: Column, names: list[str]) -> Column:
    """Not one of the names; missing counts as outside."""
    return ~F.coalesce(value.isin(names), F.lit(False))


def _misfit(value: Column, kind: str) -> Column:
    return value.isNotNull() & value.try_cast(kind).isNull()


def count_breaches(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``session_id, rule, rows, breaches`` for every rule, in one pass that combines before the shuffle."""
    totals = rows.groupBy("session_id").agg(
        F.count("*").alias("rows"), *[F.count_if(broken).alias(name) for name, broken in rules.items()]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("breaches")) for n in rules])
    return totals.select("session_id", "rows", F.explode(pairs).alias("r")).select("session_id", "r.rule", "rows", "r.breaches")


def observed(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``rows``, and what the job that uses them counts on the way: ``rows`` and the breaches of each rule, of all sessions."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(broken).alias(name) for name, broken in rules.items()]), seen


def line_rules() -> dict[str, Column]:
    return {fault: F.col("fault").eqNullSafe(F.lit(fault)) for fault in archive.FAULTS}


def payload_rules(columns: dict[str, str]) -> dict[str, Column]:
    """Rules of :func:`type_report` for values looked up in whole entries."""
    values = F.from_json("payload", ", ".join(f"`{k}` STRING" for k in columns))
    return {k: _misfit(values[k], kind) for k, kind in columns.items()}


def line_report(lines: DataFrame, compressed: bool = False) -> DataFrame:
    """Lines of a stream file that cannot be read: no payload ``mark``, no ``clock``, a broken ``blob`` or broken ``json``."""
    rows = archive.judged_lines(lines, compressed)
    return count_breaches(rows, line_rules())


def race_control_report(docs: DataFrame) -> DataFrame:
    rows = parsed(docs.select("session_id", "doc"), "Messages STRING", source="doc").select("session_id", "p.Messages")
    rows = explode_object_items(rows, "Messages", "_p", "_k", "value")
    rows = rows.withColumn(
        "c",
        F.from_json(
            "value",
            "Utc STRING, Lap STRING, Message STRING, Category STRING, Flag STRING, Scope STRING, Sector STRING, "
            "Status STRING, Mode STRING",
        ),
    ).select("session_id", "c.*")
    flag, car, drs = (F.col("Category") == n for n in ("Flag", "SafetyCar", "Drs"))
    rules = {
        "category": _outside(F.col("Category"), CATEGORIES),
        "message": F.col("Message").isNull(),
        "utc": parse.utc(F.col("Utc")).isNull(),
        "lap": _misfit(F.col("Lap"), "int"),
        "flag": flag & _outside(F.col("Flag"), FLAGS),
        "scope": flag & _outside(F.col("Scope"), SCOPES),
        "sector": flag & _misfit(F.col("Sector"), "int"),
        "safety_car_status": car & _outside(F.col("Status"), SAFETY_CAR_STATUS),
        "safety_car_mode": car & _outside(parse.safety_car_mode(F.col("Mode")), SAFETY_CAR_MODES),
        "drs_status": drs & _outside(F.col("Status"), DRS_STATUS),
    }
    return count_breaches(rows, rules)


def tyre_report(docs: DataFrame) -> DataFrame:
    rows = parsed(docs.select("session_id", "doc"), "Tyres STRING", source="doc").select("session_id", "p.Tyres")
    rows = explode_object_items(rows, "Tyres", "_p", "_k", "value")
    rows = rows.withColumn("c", F.from_json("value", "Compound STRING, New STRING")).select("session_id", "c.*")
    rules = {
        "compound": _outside(F.col("Compound"), parse.COMPOUNDS),
        "new": F.col("New").try_cast("boolean").isNull(),
    }
    return count_breaches(rows, rules)


def lap_time_report(docs: DataFrame) -> DataFrame:
    """Lap texts of timing keyframes that are neither empty nor a lap time."""
    rows = parsed(docs.select("session_id", "doc"), "Lines STRING", source="doc").select("session_id", "p.Lines")
    rows = explode_object_items(rows, "Lines", "_p", "_k", "value")
    rows = rows.withColumn(
        "c", F.from_json("value", "BestLapTime STRUCT<Value: STRING>, LastLapTime STRUCT<Value: STRING>")
    )
    rules = {
        name: F.coalesce((F.col(f) != "") & ~F.col(f).rlike(parse.LAP_TEXT), F.lit(False))
        for name, f in (("best_lap_time", "c.BestLapTime.Value"), ("last_lap_time", "c.LastLapTime.Value"))
    }
    return count_breaches(rows, rules)


def session_report(sessions: DataFrame) -> DataFrame:
    """Session names and types outside the vocabularies, per year (given as ``session_id``)."""
    rows = sessions.select(F.col("year").cast("string").alias("session_id"), "type", "raw_name")
    rules = {
        "session_type": F.col("type").isNotNull() & _outside(F.col("type"), SESSION_TYPES),
        "session_name": F.col("raw_name").isNotNull() & _outside(session_name(F.col("raw_name")), SESSION_NAMES),
    }
    return count_breaches(rows, rules)


def type_report(raw: DataFrame, columns: dict[str, str], field: str | None = None) -> DataFrame:
    """Values of raw entries that are there but do not fit their column's type.

    ``columns`` maps JSON keys to Spark types. They are looked up in the payload, or in each object among the
    children of ``field``.
    """
    if field is None:
        rows = raw.select("session_id", F.col("payload").alias("value"))
    else:
        rows = parsed(raw.select("session_id", "payload"), f"{field} STRING").select("session_id", f"p.{field}")
        rows = explode_object_items(rows, field, "_p", "_k", "value")
    rows = rows.withColumn("c", F.from_json("value", ", ".join(f"`{k}` STRING" for k in columns))).select("session_id", "c.*")
    return count_breaches(rows, {k: _misfit(F.col(k), kind) for k, kind in columns.items()})


# Ranges of the unsigned and short columns the feeds are meant to fit.
RANGES = {
    "racing_number": (0, 255),
    "rpm": (0, 65_535),
    "speed": (0, 65_535),
    "gear": (0, 255),
    "brake": (0, 255),
    "drs": (0, 255),
}


def range_report(rows: DataFrame, ranges: dict[str, tuple[int, int]] = RANGES) -> DataFrame:
    """Values of a telemetry table that leave the range their column is meant for."""
    rules = {f"{c}_range": F.coalesce(~F.col(c).between(lo, hi), F.lit(False)) for c, (lo, hi) in ranges.items()}
    return count_breaches(rows, rules)
