"""Stream feeds: raw entries to one flat typed table per feed.

Every function takes raw entries (``session_id, block_no, line_no, entry_no, timestamp_ms, payload``) and
keeps that lineage, plus ``key_pos`` where an entry yields several rows. All of them are narrow: no
shuffle, so they run at the speed of the scan and any group may be as large as it likes.

``compat=True`` keeps a literal oddity of the feed's original reader; the default is the documented meaning.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slipstream.functions import parse
from slipstream.functions.jsonwalk import (
    ENTRY,
    LINEAGE,
    bound,
    entries_of,
    explode_items,
    explode_map,
    explode_object_items,
    explode_objects,
    is_list,
    is_object,
    is_text,
    judged,
    mapped,
    ordered_entries,
    parsed,
    parsed_strictly,
)
from slipstream.operators import ordered
from slipstream.sources import archive

TEXT, BYTE, SHORT, WORD, REAL, FLAG = "string", "smallint", "smallint", "int", "double", "boolean"


def _cast(source: Column, kind: str) -> Column:
    return source if kind == TEXT else source.try_cast(kind)


def _leaves(parent: str, *columns: tuple[str, str, str]) -> list[Column]:
    """Typed columns from ``(name, JSON key, type)`` under a parsed struct of texts."""
    return [_cast(F.col(f"{parent}.{key}"), kind).alias(name) for name, key, kind in columns]


def _texts(*keys: str) -> str:
    return ", ".join(f"`{k}` STRING" for k in keys)


def _when_text(json: str, field: str, value: str) -> Column:
    """The value only if the JSON holds it as a string."""
    return F.when(is_text(F.col(json), field), F.col(value))


def _child(df: DataFrame, *keys: str, value: str = "value", out: str = "c") -> DataFrame:
    return df.withColumn(out, F.from_json(value, _texts(*keys)))


def _pascal(name: str) -> str:
    return "".join(w.capitalize() for w in name.split("_"))


def flat_feed(raw: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """Default shape: each column looked up in the payload under its PascalCase name, one row per entry."""
    wanted = [(name, _pascal(name), kind) for name, kind in columns]
    rows = parsed(raw, _texts(*(key for _, key, _ in wanted)))
    return rows.select(*ENTRY, *_leaves("p", *wanted))


# Telemetry

# Telemetry channel numbers.
CHANNELS = {"rpm": "0", "speed": "2", "gear": "3", "throttle": "4", "brake": "5", "drs": "45"}
CHANNEL_TYPES = {"rpm": WORD, "speed": WORD, "gear": BYTE, "throttle": REAL, "brake": BYTE, "drs": BYTE}


CHANNEL_FIELDS = "STRUCT<`0`: INT, `2`: INT, `3`: INT, `4`: DOUBLE, `5`: INT, `45`: INT>"
CAR_SCHEMA = f"Utc: STRING, Cars: MAP<STRING, STRUCT<Channels: {CHANNEL_FIELDS}>>"
POSITION_SCHEMA = "Timestamp: STRING, Entries: MAP<STRING, STRUCT<Status: STRING, X: DOUBLE, Y: DOUBLE, Z: DOUBLE>>"


def channel(name: str, channels: Column) -> Column:
    """A telemetry channel from a map of texts; an absent one reads 0, but for DRS null."""
    value = F.element_at(channels, CHANNELS[name])
    if name != "drs":
        present = F.coalesce(F.map_contains_key(channels, CHANNELS[name]), F.lit(False))
        value = F.when(present, value).otherwise("0")
    return value.try_cast(CHANNEL_TYPES[name]).alias(name)


def _cars_of_text(payload: Column) -> Column:
    """Cars of an entry whose shape is unusual, as the typed parse would give them, absent channels filled."""

    def fields(channels: Column) -> Column:
        return F.struct(*[channel(n, channels).cast("double" if n == "throttle" else "int").alias(CHANNELS[n]) for n in CHANNELS])

    def car(e: Column) -> Column:
        channels = F.from_json(e["value"], "Channels MAP<STRING,STRING>")["Channels"]
        return F.struct(e["key"].alias("key"), F.struct(bound(channels, fields).alias("Channels")).alias("value"))

    cars = entries_of(payload, "Cars MAP<STRING,STRING>", "Cars")
    return F.transform(F.filter(cars, lambda e: is_object(e["value"])), car)


def _points_of_text(payload: Column) -> Column:
    def typed(c: Column) -> Column:
        return F.struct(c["Status"].alias("Status"), *[c[axis].try_cast(REAL).alias(axis) for axis in "XYZ"])

    def point(e: Column) -> Column:
        return F.struct(e["key"].alias("key"), bound(F.from_json(e["value"], _texts("Status", *"XYZ")), typed).alias("value"))

    points = entries_of(payload, "Entries MAP<STRING,STRING>", "Entries")
    return F.transform(F.filter(points, lambda e: is_object(e["value"])), point)


def _car_table(rows: DataFrame) -> DataFrame:
    """Rows of ``odd, utc, key_pos, car`` to telemetry columns."""

    def value(name: str) -> Column:
        found = F.col(f"car.value.Channels.{CHANNELS[name]}")
        if name != "drs":
            found = F.when(F.col("odd"), found).otherwise(F.coalesce(found, F.lit(0)))
        return found.try_cast(CHANNEL_TYPES[name]).alias(name)

    return rows.select(
        *LINEAGE,
        parse.utc(F.col("utc")).alias("utc"),
        F.col("car.key").try_cast(BYTE).alias("racing_number"),
        *[value(n) for n in CHANNELS],
    )


def _position_table(rows: DataFrame) -> DataFrame:
    return rows.filter("car.value IS NOT NULL").select(
        *LINEAGE,
        "utc",
        F.col("car.key").try_cast(BYTE).alias("racing_number"),
        *[F.col(f"car.value.{n}").alias(n.lower()) for n in ("Status", *"XYZ")],
    )


def _telemetry(raw: DataFrame, schema: str, field: str, clock: str, of_text: Callable[[Column], Column]) -> DataFrame:
    """Explode raw entries to cars: one typed parse, and the text taken apart only where that did not fit."""
    rows = parsed_strictly(raw, schema, "payload").withColumn("odd", _odd("payload"))
    cars = F.when(F.col("odd"), of_text(F.col("payload"))).otherwise(ordered_entries(F.col(f"p.{field}")))
    return rows.select(*ENTRY, "odd", F.col(f"p.{clock}").alias("utc"), F.posexplode(cars).alias("key_pos", "car"))


def _telemetry_docs(docs: DataFrame, schema: str, field: str, clock: str, of_text: Callable[[Column], Column]) -> DataFrame:
    """As :func:`_telemetry` straight from inflated documents, which hold several entries each."""
    rows = parsed_strictly(docs, f"Entries: ARRAY<STRUCT<{schema}>>, Position: ARRAY<STRUCT<{schema}>>", "doc")
    rows = rows.withColumn("odd", _odd("doc"))

    def typed(e: Column) -> Column:
        return F.struct(e[clock].alias("utc"), bound(e[field], ordered_entries).alias("cars"))

    def texts(payload: Column) -> Column:
        return F.struct(F.from_json(payload, f"{clock} STRING")[clock].alias("utc"), of_text(payload).alias("cars"))

    listed = bound(
        F.from_json("doc", "Entries ARRAY<STRING>, Position ARRAY<STRING>"),
        lambda d: F.transform(F.coalesce(d["Entries"], d["Position"]), texts),
    )
    entries = F.when(F.col("odd"), listed).otherwise(F.transform(F.coalesce("p.Entries", "p.Position"), typed))
    rows = rows.select(*ENTRY[:3], "timestamp_ms", "odd", F.posexplode(entries).alias("entry_no", "e"))
    return rows.select(*ENTRY, "odd", F.col("e.utc").alias("utc"), F.posexplode("e.cars").alias("key_pos", "car"))


def _odd(source: str) -> Column:
    """Text that needs the longer way: it did not fit the types, or holds a null."""
    return F.col("p._odd").isNotNull() | F.contains(source, F.lit("null"))


def car_data(raw: DataFrame) -> DataFrame:
    return _car_table(_telemetry(raw, CAR_SCHEMA, "Cars", "Utc", _cars_of_text))


def car_data_docs(docs: DataFrame) -> DataFrame:
    return _car_table(_telemetry_docs(docs, CAR_SCHEMA, "Cars", "Utc", _cars_of_text))


def position(raw: DataFrame) -> DataFrame:
    return _position_table(_telemetry(raw, POSITION_SCHEMA, "Entries", "Timestamp", _points_of_text))


def position_docs(docs: DataFrame) -> DataFrame:
    return _position_table(_telemetry_docs(docs, POSITION_SCHEMA, "Entries", "Timestamp", _points_of_text))


# Timing


def _lines(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, "Lines MAP<STRING,STRING>").select(*ENTRY, "p.Lines")
    return explode_objects(rows, "Lines")


SEGMENT_SCHEMA = "Lines: MAP<STRING, STRUCT<Sectors: MAP<STRING, STRUCT<Segments: MAP<STRING, STRUCT<Status: INT>>>>>>"


def _items_of(text: Column) -> Column:
    """Key and text of each object among the children of an object or a list."""
    listed = F.transform(
        F.when(is_list(text), F.from_json(text, "ARRAY<STRING>")),
        lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")),
    )
    mapped = F.when(is_object(text), entries_of(text))
    return F.filter(F.coalesce(mapped, listed), lambda e: is_object(e["value"]))


def _lines_of_text(payload: Column) -> Column:
    """Lines of an entry that has lists or other shapes, as the typed parse would give them."""

    def level(field: str, child: Callable[[Column], Column]) -> Callable[[Column], Column]:
        def struct(json: Column) -> Column:
            items = bound(F.from_json(json, f"{field} STRING")[field], _items_of)
            pairs = F.transform(items, lambda e: F.struct(e["key"].alias("key"), child(e["value"]).alias("value")))
            return F.struct(F.map_from_entries(pairs).alias(field))

        return struct

    def status(json: Column) -> Column:
        return F.struct(F.from_json(json, "Status STRING")["Status"].try_cast(WORD).alias("Status"))

    line = level("Sectors", level("Segments", status))
    lines = F.filter(entries_of(payload, "Lines MAP<STRING,STRING>", "Lines"), lambda e: is_object(e["value"]))
    return F.transform(lines, lambda e: F.struct(e["key"].alias("key"), line(e["value"]).alias("value")))


def timing_segments(raw: DataFrame) -> DataFrame:
    """Segment status changes: car, sector (from 1), segment (from 0).

    Deltas are objects all the way down and take one typed parse; a snapshot's lists take the longer way.
    """
    rows = parsed_strictly(raw, SEGMENT_SCHEMA, "payload")
    lines = F.when(F.col("p._odd").isNotNull(), _lines_of_text(F.col("payload"))).otherwise(
        ordered_entries(F.col("p.Lines"))
    )
    cars = rows.select(*ENTRY, F.posexplode(lines).alias("key_pos", "car"))
    sectors = cars.select(
        *LINEAGE,
        F.col("car.key").alias("car_number"),
        F.explode(ordered_entries(F.col("car.value.Sectors"))).alias("s"),
    )
    segments = sectors.select(
        *LINEAGE,
        "car_number",
        F.col("s.key").alias("sector"),
        F.explode(ordered_entries(F.col("s.value.Segments"))).alias("g"),
    )
    return segments.filter("g.value.Status IS NOT NULL").select(
        *LINEAGE,
        "car_number",
        (F.col("sector").try_cast("int") + 1).try_cast(BYTE).alias("sector"),
        F.col("g.key").try_cast(BYTE).alias("segment"),
        F.col("g.value.Status").alias("status"),
    )


def timing_stats(raw: DataFrame) -> DataFrame:
    """Best speeds, best sectors and personal bests in one pass; foreign columns are null."""
    cars = _lines(raw).withColumnRenamed("key", "car_number")
    cars = cars.withColumn(
        "s", F.from_json("value", "BestSpeeds STRING, BestSectors STRING, PersonalBestLapTime STRING")
    )
    cars = cars.select(
        *LINEAGE,
        "car_number",
        F.when(is_object(F.col("s.BestSpeeds")), F.from_json("s.BestSpeeds", "MAP<STRING,STRING>")).alias("speeds"),
        F.when(is_object(F.col("s.BestSectors")), F.from_json("s.BestSectors", "MAP<STRING,STRING>")).alias("sectors"),
        F.when(is_list(F.col("s.BestSectors")), F.from_json("s.BestSectors", "ARRAY<STRING>")).alias("sector_list"),
        F.col("s.PersonalBestLapTime").alias("best"),
    )

    def kinds(name: str, m: str) -> Column:
        return F.transform(
            F.coalesce(ordered_entries(F.col(m)), F.array().cast("array<struct<key:string,value:string>>")),
            lambda e: F.struct(F.lit(name).alias("kind"), e["key"].alias("item"), e["value"].alias("value")),
        )

    listed = F.transform(
        F.coalesce(F.col("sector_list"), F.array().cast("array<string>")),
        lambda v, i: F.struct(F.lit("sector").alias("kind"), i.cast("string").alias("item"), v.alias("value")),
    )
    best = F.array(F.struct(F.lit("personal_best").alias("kind"), F.lit("").alias("item"), F.col("best").alias("value")))
    stats = F.concat(kinds("speed", "speeds"), kinds("sector", "sectors"), listed, best)
    rows = cars.select(*LINEAGE, "car_number", F.explode(stats).alias("e")).select(*LINEAGE, "car_number", "e.*")
    rows = _child(rows.filter(is_object(F.col("value"))), "Value", "Position", "Lap")

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    return rows.select(
        *LINEAGE,
        "car_number",
        F.col("kind").alias("stat_type"),
        *_leaves("c", ("position", "Position", BYTE)),
        of("speed", F.col("item")).alias("trap"),
        of("speed", F.col("c.Value").try_cast(WORD)).alias("speed"),
        of("sector", F.col("item").try_cast(BYTE)).alias("sector"),
        of("sector", F.col("c.Value").try_cast(REAL)).alias("time_seconds"),
        of("personal_best", parse.lap_ms(_when_text("value", "Value", "c.Value"))).alias("lap_time_ms"),
        of("personal_best", F.col("c.Lap").try_cast(WORD)).alias("lap"),
    )


def _new_flag(json: str, value: str) -> Column:
    """Text "true" or not; a value that is no text is unknown."""
    return _when_text(json, "New", value) == "true"


def timing_app(raw: DataFrame) -> DataFrame:
    """Stint deltas per car; null means no change."""
    cars = _lines(raw).withColumn("stints", F.from_json("value", "Stints STRING")["Stints"]).drop("value")
    cars = cars.withColumnRenamed("key", "car_number")
    stints = explode_object_items(cars, "stints", "_p1", "stint", "value")
    keys = ["Compound", "New", "TyresNotChanged", "TotalLaps", "StartLaps", "LapTime", "LapNumber", "LapFlags"]
    return _child(stints, *keys).select(
        *LINEAGE,
        "car_number",
        F.col("stint").try_cast(BYTE).alias("stint_number"),
        F.col("c.Compound").alias("compound"),
        _new_flag("value", "c.New").alias("new"),
        *_leaves(
            "c",
            ("tyres_not_changed", "TyresNotChanged", BYTE),
            ("total_laps", "TotalLaps", WORD),
            ("start_laps", "StartLaps", WORD),
            ("lap_time", "LapTime", TEXT),
            ("lap_number", "LapNumber", WORD),
            ("lap_flags", "LapFlags", BYTE),
        ),
    )


def lap_series(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Position per car and lap. ``compat`` skips list snapshots, whose index is the lap."""
    cars = explode_objects(mapped(raw), "m")
    cars = cars.withColumn("laps", F.from_json("value", "LapPosition STRING")["LapPosition"]).drop("value")
    laps = explode_items(cars.withColumnRenamed("key", "car"), "laps", "_p1", "lap", "value", lists=not compat)
    return laps.select(
        *LINEAGE,
        F.col("car").try_cast(BYTE).alias("racing_number"),
        F.col("lap").try_cast(BYTE).alias("lap"),
        F.col("value").try_cast(BYTE).alias("position"),
    )


def lap_count(raw: DataFrame) -> DataFrame:
    """One row per entry; ``total_laps`` is kept beside the lap for the session totals."""
    rows = parsed(raw, _texts("CurrentLap", "TotalLaps"), out="c", keep=True)
    quoted = F.coalesce(is_text(F.col("payload"), "TotalLaps"), F.lit(False))
    return rows.select(
        *ENTRY,
        F.col("c.CurrentLap").try_cast(BYTE).alias("lap"),
        F.when(~quoted, F.col("c.TotalLaps").try_cast(WORD)).alias("total_laps"),
    )


def tyre_stints(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Stints per car. ``compat`` skips list snapshots."""
    cars = explode_map(parsed(raw, "Stints MAP<STRING,STRING>").select(*ENTRY, "p.Stints"), "Stints", key="car")
    stints = explode_object_items(
        cars.withColumnRenamed("value", "items"), "items", "_p1", "stint", "value", lists=not compat
    )
    return _child(stints, "Compound", "New", "TyresNotChanged", "TotalLaps", "StartLaps").select(
        *LINEAGE,
        F.col("car").try_cast(BYTE).alias("car_number"),
        F.col("stint").try_cast(BYTE).alias("stint_index"),
        F.col("c.Compound").alias("compound"),
        _new_flag("value", "c.New").alias("new"),
        *_leaves(
            "c",
            ("tyres_not_changed", "TyresNotChanged", BYTE),
            ("total_laps", "TotalLaps", WORD),
            ("start_laps", "StartLaps", WORD),
        ),
    )


def current_tyres(raw: DataFrame) -> DataFrame:
    cars = explode_objects(parsed(raw, "Tyres MAP<STRING,STRING>").select(*ENTRY, "p.Tyres"), "Tyres")
    cars = cars.withColumn("c", F.from_json("value", "MAP<STRING,STRING>"))
    worn = F.when(F.map_contains_key("c", "New"), F.element_at("c", "New")).otherwise("false")
    return cars.select(
        *LINEAGE,
        F.col("key").try_cast(BYTE).alias("racing_number"),
        parse.compound(F.element_at("c", "Compound")).alias("compound"),
        worn.try_cast(FLAG).alias("new"),
    )


def _tracker_columns() -> list[Column]:
    return [
        F.col("c.LapState").try_cast(SHORT).alias("lap_state"),
        parse.lap_ms(F.col("c.LapTime")).alias("lap_time_ms"),
        parse.gap(_when_text("value", "DiffToAhead", "c.DiffToAhead")).alias("diff_to_ahead"),
        parse.gap(_when_text("value", "DiffToLeader", "c.DiffToLeader")).alias("diff_to_leader"),
    ]


def driver_tracker(raw: DataFrame) -> DataFrame:
    return _child(_lines(raw), "LapState", "LapTime", "DiffToAhead", "DiffToLeader").select(
        *LINEAGE, F.col("key").try_cast(BYTE).alias("racing_number"), *_tracker_columns()
    )


def top_three(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Leading three lines. ``compat`` skips list snapshots."""
    rows = parsed(raw, "Lines STRING").select(*ENTRY, "p.Lines")
    rows = explode_object_items(rows, "Lines", "key_pos", "key", "value", lists=not compat)
    names = [
        ("tla", "Tla"),
        ("broadcast_name", "BroadcastName"),
        ("full_name", "FullName"),
        ("team", "Team"),
        ("team_colour", "TeamColour"),
    ]
    keys = ["RacingNumber", *(k for _, k in names), "LapState", "LapTime", "DiffToAhead", "DiffToLeader"]
    return _child(rows, *keys).select(
        *LINEAGE,
        (F.col("key").try_cast("int") + 1).try_cast(BYTE).alias("position"),
        *_leaves("c", ("racing_number", "RacingNumber", BYTE), *((n, k, TEXT) for n, k in names)),
        *_tracker_columns(),
    )


# Pit lane


def pit_stop(raw: DataFrame) -> DataFrame:
    """Pit stops; a missing lap takes the lap of the row before, whatever the car."""
    rows = flat_feed(raw, [("racing_number", BYTE), ("pit_stop_time", REAL), ("pit_lane_time", REAL), ("lap", BYTE)])
    return ordered.fill_forward(rows, ["session_id"], F.col("lap"), "lap", order=["block_no", "line_no", "entry_no"])


def pit_stop_series(raw: DataFrame, compat: bool = False) -> DataFrame:
    """All stops of each car in an update. ``compat`` keeps only the first of a car."""
    cars = explode_map(parsed(raw, "PitTimes MAP<STRING,STRING>").select(*ENTRY, "p.PitTimes"), "PitTimes")
    stops = explode_items(cars.withColumnRenamed("value", "stops"), "stops", "_p1", "_k1", "value")
    stops = stops.filter(F.col("_p1") == 0) if compat else stops
    stops = _child(stops.filter(is_object(F.col("value"))), "Timestamp", "PitStop")
    stops = stops.withColumn("s", F.from_json("c.PitStop", _texts("PitStopTime", "PitLaneTime", "Lap")))
    return stops.select(
        *LINEAGE,
        parse.utc(F.col("c.Timestamp")).alias("utc"),
        F.col("key").try_cast(BYTE).alias("racing_number"),
        *_leaves("s", ("pit_stop_time", "PitStopTime", REAL), ("pit_lane_time", "PitLaneTime", REAL), ("lap", "Lap", BYTE)),
    )


def pit_lane_marks(raw: DataFrame) -> DataFrame:
    """Pit lane inserts and delete marks in arrival order, before deletes are applied.

    A mark is an object with a duration (insert), an object without one, or one item of a list of cars.
    ``first_duration`` is that of the entry's first mark.
    """
    rows = parsed(raw, "PitTimes MAP<STRING,STRING>").select(*ENTRY, "p.PitTimes")
    keys = ["RacingNumber", "Duration", "Lap", "_deleted"]

    def of_list(text: Column) -> Column:
        return F.transform(
            F.from_json(text, "ARRAY<STRING>"),
            lambda v: F.struct(
                v.alias("RacingNumber"),
                F.lit(None).cast("string").alias("Duration"),
                F.lit(None).cast("string").alias("Lap"),
                F.lit("true").alias("_deleted"),
            ),
        )

    def of_child(e: Column) -> Column:
        one = F.when(is_object(e["value"]), F.array(F.from_json(e["value"], _texts(*keys))))
        return F.coalesce(
            one,
            F.when(is_list(e["value"]), of_list(e["value"])),
            F.array().cast(mark),
        )

    mark = f"array<struct<{', '.join(f'{k}:string' for k in keys)}>>"
    marks = rows.withColumn("marks", F.flatten(F.transform(ordered_entries(F.col("PitTimes")), of_child)))
    # An expression, not the bare column: exploding a column makes Spark infer a filter that recomputes it.
    each = F.posexplode(F.coalesce("marks", F.array().cast(mark)))
    marks = marks.select(*ENTRY, F.get("marks", F.lit(0))["Duration"].alias("first_duration"), each.alias("key_pos", "c"))
    return marks.select(
        *LINEAGE,
        "first_duration",
        *_leaves("c", ("racing_number", "RacingNumber", BYTE), ("duration", "Duration", REAL), ("lap", "Lap", BYTE)),
        F.when(F.col("c._deleted").isNotNull(), F.col("timestamp_ms")).alias("broadcast_deleted_at_ms"),
    )


def pit_lane_times(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Pit lane times with later deletes patched back onto the insert they cancel.

    Each mark is judged by itself. With ``compat`` a whole entry is judged by its first mark, so inserts
    after a delete count as deletes, and deletes after an insert stay as rows.
    """
    marks = pit_lane_marks(raw)
    insert = F.col("first_duration" if compat else "duration").isNotNull()
    return ordered.patch_back(
        marks.withColumn("is_insert", insert).drop("first_duration"),
        keys=["session_id", "racing_number"],
        patched="broadcast_deleted_at_ms",
        is_insert="is_insert",
        order=["block_no", "line_no", "entry_no", "key_pos"],
    )


# Race control and track state


def race_control(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, "Messages STRING").select(*ENTRY, "p.Messages")
    rows = explode_object_items(rows, "Messages", "key_pos", "key", "value")
    columns = [
        ("utc", "Utc", TEXT),
        ("category", "Category", TEXT),
        ("message", "Message", TEXT),
        ("lap", "Lap", BYTE),
        ("flag", "Flag", TEXT),
        ("scope", "Scope", TEXT),
        ("sector", "Sector", BYTE),
        ("racing_number", "RacingNumber", TEXT),
        ("status", "Status", TEXT),
        ("mode", "Mode", TEXT),
    ]
    return _child(rows, *(k for _, k, _ in columns)).select(*LINEAGE, *_leaves("c", *columns))


def tla_rcm(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, _texts("Timestamp", "Message"))
    return rows.select(*ENTRY, parse.utc(F.col("p.Timestamp")).alias("utc"), F.col("p.Message").alias("message"))


def track_status(raw: DataFrame) -> DataFrame:
    return flat_feed(raw, [("status", BYTE), ("message", TEXT)])


def session_status(raw: DataFrame) -> DataFrame:
    return flat_feed(raw, [("status", TEXT), ("started", TEXT)])


def archive_status(raw: DataFrame) -> DataFrame:
    return flat_feed(raw, [("status", TEXT)])


# Weather

WEATHER = [
    ("air_temp", REAL),
    ("humidity", REAL),
    ("pressure", REAL),
    ("rainfall", REAL),
    ("track_temp", REAL),
    ("wind_direction", WORD),
    ("wind_speed", REAL),
]


def weather(raw: DataFrame) -> DataFrame:
    return flat_feed(raw, WEATHER)


def weather_series(raw: DataFrame, compat: bool = False) -> DataFrame:
    """All readings of the series. ``compat`` keeps only the first reading of a list, also of one inside a child."""
    rows = parsed(raw, "Series STRING").select(*ENTRY, "p.Series").withColumn("listed", is_list(F.col("Series")))
    rows = explode_items(rows, "Series", "key_pos", "key", "value").filter("value IS NOT NULL")
    if compat:
        rows = rows.filter(~F.col("listed") | (F.col("key_pos") == 0))
    inner = F.from_json("value", "ARRAY<STRING>")
    inner = F.slice(inner, 1, 1) if compat else inner
    # outer: an empty list is a reading without values, as the list of one null is
    each = F.explode_outer(F.when(is_list(F.col("value")), inner).otherwise(F.array("value"))).alias("value")
    rows = rows.select(*[c for c in rows.columns if c != "value"], each)
    rows = rows.withColumn("c", F.from_json("value", f"Timestamp STRING, Weather STRUCT<{_colon(WEATHER)}>"))
    return rows.select(
        *LINEAGE,
        parse.utc(F.col("c.Timestamp")).alias("utc"),
        *_leaves("c.Weather", *((n, _pascal(n), k) for n, k in WEATHER)),
    )


def _colon(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{_pascal(n)}: STRING" for n, _ in columns)


# Drivers and standings


def _drivers(raw: DataFrame) -> DataFrame:
    return explode_objects(mapped(raw), "m")


def driver_list(raw: DataFrame) -> DataFrame:
    """Display line per car, for updates that name it."""
    rows = _drivers(raw).withColumn("c", F.from_json("value", "MAP<STRING,STRING>"))
    return rows.filter(F.map_contains_key("c", "Line")).select(
        *LINEAGE, F.col("key").alias("car_number"), F.element_at("c", "Line").try_cast(BYTE).alias("line")
    )


def driver_race_rows(raw: DataFrame, outer: bool = False) -> DataFrame:
    """Race info updates of every entry, before the snapshot is set apart.

    With ``outer`` an entry that names no car gives one row without a car.
    """
    keys = ["Position", "Gap", "Interval", "Catching", "OvertakeState", "PitStops", "IsOut"]
    cars = _drivers(raw) if not outer else explode_map(mapped(raw), "m", keep=lambda e: is_object(e["value"]))
    rows = _child(cars, *keys).withColumn("gap", parse.race_gap(_when_text("value", "Gap", "c.Gap")))

    def code(field: str, names: dict[int, str]) -> Column:
        quoted = F.coalesce(is_text(F.col("value"), field), F.lit(False))
        return parse.code_name(F.when(~quoted, F.col(f"c.{field}")), names)

    return rows.select(
        *LINEAGE,
        F.col("key").alias("car_number"),
        *_leaves("c", ("position", "Position", BYTE)),
        "gap.gap_seconds",
        F.col("gap.laps_behind").cast(BYTE).alias("laps_behind"),
        parse.interval_seconds(_when_text("value", "Interval", "c.Interval")).alias("interval_seconds"),
        code("Catching", parse.CATCHING).alias("catching"),
        code("OvertakeState", parse.OVERTAKE_STATE).alias("overtake_state"),
        "gap.is_leader",
        "gap.leader_lap",
        *_leaves("c", ("pit_stops", "PitStops", BYTE), ("is_out", "IsOut", FLAG)),
    )


def driver_race_info(raw: DataFrame) -> DataFrame:
    """Updates after the opening snapshot; of several at one clock the last per car counts.

    Snapshot and updates come from one read: entries without a car keep a row, so that the aggregate which reduces the
    rows also knows the first entry of every session.
    """
    rows = driver_race_rows(raw, outer=True)
    keys, place = ["session_id", "timestamp_ms", "car_number"], ["block_no", "line_no", "entry_no", "key_pos"]
    return ordered.last_per_key_after_first_entry(rows, keys, place).filter("key_pos IS NOT NULL")


def starting_grid(raw: DataFrame) -> DataFrame:
    """Grid from the opening snapshot, by position, with the rank in the session."""
    rows = driver_race_rows(ordered.first_entry(judged(raw))).filter("position IS NOT NULL")
    rank = F.rank().over(Window.partitionBy("session_id").orderBy("position")).alias("grid_rank")
    return rows.select(*LINEAGE, "position", "car_number", rank).orderBy("session_id", "position")


def championship(raw: DataFrame) -> DataFrame:
    """Predicted standings of drivers and teams as one table."""
    rows = parsed(raw, "Drivers MAP<STRING,STRING>, Teams MAP<STRING,STRING>").select(*ENTRY, "p.*")

    def kind(name: str, m: str) -> Column:
        entries = F.coalesce(ordered_entries(F.col(m)), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(
            entries, lambda e: F.struct(F.lit(name).alias("entry_type"), e["key"].alias("entry_key"), e["value"].alias("value"))
        )

    rows = rows.select(
        *ENTRY, F.posexplode(F.concat(kind("driver", "Drivers"), kind("team", "Teams"))).alias("key_pos", "e")
    ).select(*LINEAGE, "e.*")
    return _child(rows.filter(is_object(F.col("value"))), "PredictedPosition", "PredictedPoints").select(
        *LINEAGE,
        "entry_type",
        "entry_key",
        *_leaves("c", ("predicted_position", "PredictedPosition", BYTE), ("predicted_points", "PredictedPoints", REAL)),
    )


def overtakes(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, "Overtakes STRING").select(*ENTRY, "p.Overtakes")
    cars = explode_items(rows, "Overtakes", "key_pos", "car", "events")
    events = explode_object_items(cars, "events", "_p1", "_k1", "value")
    events = events.withColumn("c", F.from_json("value", "MAP<STRING,STRING>"))
    return events.select(
        *LINEAGE,
        parse.utc_ms(F.element_at("c", "Timestamp")).alias("utc"),
        F.col("car").try_cast(BYTE).alias("racing_number"),
        F.coalesce(F.element_at("c", "count"), F.element_at("c", "Count")).try_cast(BYTE).alias("count"),
    )


# Session state

SESSION_INFO_SCHEMA = """
Meeting STRUCT<Key: STRING, Name: STRING, OfficialName: STRING, Location: STRING, Number: STRING,
  Country: STRUCT<Key: STRING, Code: STRING, Name: STRING>, Circuit: STRUCT<Key: STRING, ShortName: STRING>>,
ArchiveStatus STRUCT<Status: STRING>, SessionStatus STRING, Key STRING, Type STRING, Number STRING, Name STRING,
StartDate STRING, EndDate STRING, GmtOffset STRING, Path STRING
"""


def session_info_columns() -> list[Column]:
    return _leaves(
        "p",
        ("meeting_key", "Meeting.Key", WORD),
        ("meeting_name", "Meeting.Name", TEXT),
        ("meeting_official_name", "Meeting.OfficialName", TEXT),
        ("meeting_location", "Meeting.Location", TEXT),
        ("meeting_number", "Meeting.Number", BYTE),
        ("country_key", "Meeting.Country.Key", WORD),
        ("country_code", "Meeting.Country.Code", TEXT),
        ("country_name", "Meeting.Country.Name", TEXT),
        ("circuit_key", "Meeting.Circuit.Key", WORD),
        ("circuit_short_name", "Meeting.Circuit.ShortName", TEXT),
        ("session_status", "SessionStatus", TEXT),
        ("archive_status", "ArchiveStatus.Status", TEXT),
        ("session_key", "Key", WORD),
        ("session_type", "Type", TEXT),
        ("session_number", "Number", BYTE),
        ("session_name", "Name", TEXT),
        ("start_date", "StartDate", TEXT),
        ("end_date", "EndDate", TEXT),
        ("gmt_offset", "GmtOffset", TEXT),
        ("path", "Path", TEXT),
    )


def session_info(raw: DataFrame) -> DataFrame:
    return parsed(raw, SESSION_INFO_SCHEMA).select(*ENTRY, *session_info_columns())


def session_data(raw: DataFrame, compat: bool = False) -> DataFrame:
    """Lap and status marks of a session, one row per item.

    ``compat`` gives one row per entry: its last section with the last item's values (a list counts its
    first item only), and a row of nulls for an empty entry.
    """
    sections = mapped(raw)
    keys = ["Utc", "Lap", "TrackStatus", "SessionStatus"]
    if compat:
        last = sections.withColumn("e", F.try_element_at(ordered_entries(F.col("m")), F.lit(-1)))
        text = F.col("e.value")
        first_item = F.get(F.from_json(text, "ARRAY<STRING>"), F.lit(0))
        last_item = F.try_element_at(F.map_values(F.from_json(text, "MAP<STRING,STRING>")), F.lit(-1))
        item = F.when(is_list(text), first_item).when(is_object(text), last_item)
        rows = last.select(*ENTRY, F.lit(0).alias("key_pos"), F.col("e.key").alias("key"), item.alias("value"))
    else:
        rows = explode_map(sections, "m", value="items")
        rows = explode_object_items(rows, "items", "_p1", "_k1", "value")
    series, status = F.col("key") == "Series", F.col("key") == "StatusSeries"
    return _child(rows, *keys).select(
        *LINEAGE,
        F.col("key").alias("series_type"),
        parse.utc(F.col("c.Utc")).alias("utc"),
        F.when(series, F.col("c.Lap").try_cast(BYTE)).alias("lap"),
        F.when(status, F.col("c.TrackStatus")).alias("track_status"),
        F.when(status, F.col("c.SessionStatus")).alias("session_status"),
    )


def extrapolated_clock(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, _texts("Utc", "Remaining", "Extrapolating"))
    return rows.select(
        *ENTRY,
        parse.utc_ms(F.col("p.Utc")).alias("utc"),
        parse.remaining_ms(F.col("p.Remaining")).alias("remaining_ms"),
        F.col("p.Extrapolating").try_cast(FLAG).alias("extrapolating"),
    )


def heartbeat(raw: DataFrame) -> DataFrame:
    return parsed(raw, _texts("Utc")).select(*ENTRY, parse.utc(F.col("p.Utc")).alias("utc"))


def content_streams(raw: DataFrame) -> DataFrame:
    rows = parsed(raw, "Streams STRING").select(*ENTRY, "p.Streams")
    rows = explode_object_items(rows, "Streams", "key_pos", "key", "value")
    names = ["type", "name", "language", "uri", "path", "utc"]
    return _child(rows, *map(_pascal, names)).select(*LINEAGE, *_leaves("c", *((n, _pascal(n), TEXT) for n in names)))


@dataclass(frozen=True)
class Feed:
    """Files of a feed and the function that flattens its stream."""

    keyframe_file: str
    stream_file: str
    flatten: Callable[..., DataFrame]
    flatten_docs: Callable[..., DataFrame] | None = None


def _feed(name: str, flatten: Callable[..., DataFrame], flatten_docs: Callable[..., DataFrame] | None = None) -> Feed:
    return Feed(f"{name}.json", f"{name}.jsonStream", flatten, flatten_docs)


FEEDS: dict[str, Feed] = {
    "CarData": _feed("CarData.z", car_data, car_data_docs),
    "Position": _feed("Position.z", position, position_docs),
    "TimingDataF1": _feed("TimingDataF1", timing_segments),
    "TimingStats": _feed("TimingStats", timing_stats),
    "TimingAppData": _feed("TimingAppData", timing_app),
    "LapSeries": _feed("LapSeries", lap_series),
    "LapCount": _feed("LapCount", lap_count),
    "TyreStintSeries": _feed("TyreStintSeries", tyre_stints),
    "CurrentTyres": _feed("CurrentTyres", current_tyres),
    "DriverTracker": _feed("DriverTracker", driver_tracker),
    "TopThree": _feed("TopThree", top_three),
    "PitStop": _feed("PitStop", pit_stop),
    "PitStopSeries": _feed("PitStopSeries", pit_stop_series),
    "PitLaneTimeCollection": _feed("PitLaneTimeCollection", pit_lane_times),
    "RaceControlMessages": _feed("RaceControlMessages", race_control),
    "TlaRcm": _feed("TlaRcm", tla_rcm),
    "TrackStatus": _feed("TrackStatus", track_status),
    "SessionStatus": _feed("SessionStatus", session_status),
    "ArchiveStatus": _feed("ArchiveStatus", archive_status),
    "WeatherData": _feed("WeatherData", weather),
    "WeatherDataSeries": _feed("WeatherDataSeries", weather_series),
    "DriverList": _feed("DriverList", driver_list),
    "DriverRaceInfo": _feed("DriverRaceInfo", driver_race_info),
    "ChampionshipPrediction": _feed("ChampionshipPrediction", championship),
    "OvertakeSeries": _feed("OvertakeSeries", overtakes),
    "SessionInfo": _feed("SessionInfo", session_info),
    "SessionData": _feed("SessionData", session_data),
    "ExtrapolatedClock": _feed("ExtrapolatedClock", extrapolated_clock),
    "Heartbeat": _feed("Heartbeat", heartbeat),
    "ContentStreams": _feed("ContentStreams", content_streams),
}


def read_feed(
    spark: SparkSession, root: str, name: str, sessions: Sequence[str] = ("*/*/*",), on_bad: str = "raise", **options: bool
) -> DataFrame:
    """The stream table of a feed over many sessions of an archive, in one scan."""
    feed = FEEDS[name]
    if feed.flatten_docs is None:
        return feed.flatten(archive.read_entries(spark, root, feed.stream_file, sessions, on_bad, judge=False), **options)
    lines = archive.read_stream_lines(spark, archive.feed_paths(root, feed.stream_file, sessions))
    return feed.flatten_docs(archive.inflate_lines(lines, on_bad, judge=False))
