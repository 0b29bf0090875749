"""Keyframes: one final-state document per session, flattened to typed rows.

Input is ``session_id, doc``. A document covers one session's cars, so it is small whatever the archive's
size; all functions are narrow and parallel over sessions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions import parse
from slipstream.functions.jsonwalk import (
    explode_items,
    explode_map,
    explode_object_items,
    explode_objects,
    parsed,
)
from slipstream.operators import feeds
from slipstream.operators.feeds import (
    BYTE,
    CHANNELS,
    FLAG,
    REAL,
    TEXT,
    WEATHER,
    WORD,
    _child,
    _leaves,
    _pascal,
    _texts,
    _when_text,
)

ID = ["session_id"]


def _doc(docs: DataFrame, schema: str) -> DataFrame:
    return parsed(docs.select(*ID, "doc"), schema, source="doc")


def _cars(docs: DataFrame, field: str | None) -> DataFrame:
    """One row per car object of the document, or of one of its fields."""
    if field is None:
        rows = docs.select(*ID, F.from_json("doc", "MAP<STRING,STRING>").alias("m"))
        return explode_objects(rows, "m")
    rows = _doc(docs, f"{field} STRING").select(*ID, f"p.{field}")
    return explode_object_items(rows, field, "key_pos", "key", "value")


def as_entries(docs: DataFrame) -> DataFrame:
    """Snapshots of a telemetry keyframe as raw entries without a clock."""
    rows = _doc(docs, "Entries ARRAY<STRING>, Position ARRAY<STRING>")
    return rows.select(
        *ID,
        F.lit(0).cast("bigint").alias("block_no"),
        F.lit(0).cast("bigint").alias("line_no"),
        F.posexplode(F.coalesce("p.Entries", "p.Position")).alias("entry_no", "payload"),
        F.lit(None).cast("bigint").alias("timestamp_ms"),
    )


def car_data(docs: DataFrame) -> DataFrame:
    rows = parsed(as_entries(docs), "Utc STRING, Cars MAP<STRING,STRING>").select(*ID, "entry_no", "p.*")
    cars = explode_objects(rows, "Cars")
    cars = cars.withColumn("ch", F.from_json("value", "Channels MAP<STRING,STRING>")["Channels"])
    return cars.select(
        *ID,
        F.col("Utc").alias("utc"),
        F.col("key").alias("car_number"),
        *[feeds.channel(n, F.col("ch")).cast("int").alias(n) for n in CHANNELS],
    )


def position(docs: DataFrame) -> DataFrame:
    return feeds.position(as_entries(docs)).select(*ID, "utc", "racing_number", "status", "x", "y", "z")


TRAPS = ["I1", "I2", "FL", "ST"]
TIMING_KEYS = [
    "RacingNumber", "Position", "Line", "ShowPosition", "TimeDiffToFastest", "TimeDiffToPositionAhead",
    "GapToLeader", "Retired", "InPit", "PitOut", "Stopped", "Status", "NumberOfLaps", "NumberOfPitStops",
]
TRAP_FIELDS = "Value: STRING, Status: STRING, OverallFastest: STRING, PersonalFastest: STRING"
TIMING_SCHEMA = (
    _texts(*TIMING_KEYS)
    + ", IntervalToPositionAhead STRUCT<Value: STRING, Catching: STRING>"
    + ", BestLapTime STRUCT<Value: STRING, Lap: STRING>"
    + f", LastLapTime STRUCT<{TRAP_FIELDS}>"
    + f", Speeds STRUCT<{', '.join(f'{t}: STRUCT<{TRAP_FIELDS}>' for t in TRAPS)}>"
)


def _ranked(parent: str, prefix: str) -> list[Column]:
    return _leaves(
        parent,
        (f"{prefix}_status", "Status", WORD),
        (f"{prefix}_overall_fastest", "OverallFastest", FLAG),
        (f"{prefix}_personal_fastest", "PersonalFastest", FLAG),
    )


def timing_lines(docs: DataFrame) -> DataFrame:
    """Final timing line per car."""
    cars = _cars(docs, "Lines").withColumn("c", F.from_json("value", TIMING_SCHEMA))

    def gap(field: str) -> Column:
        return parse.gap(_when_text("value", field, f"c.{field}")).alias(_snake(field))

    return cars.select(
        *ID,
        F.col("key").alias("car_number"),
        *_leaves(
            "c",
            ("racing_number", "RacingNumber", TEXT),
            ("position", "Position", TEXT),
            ("line", "Line", WORD),
            ("show_position", "ShowPosition", FLAG),
        ),
        gap("TimeDiffToFastest"),
        gap("TimeDiffToPositionAhead"),
        gap("GapToLeader"),
        *_leaves(
            "c",
            ("interval_value", "IntervalToPositionAhead.Value", TEXT),
            ("interval_catching", "IntervalToPositionAhead.Catching", FLAG),
            ("retired", "Retired", FLAG),
            ("in_pit", "InPit", FLAG),
            ("pit_out", "PitOut", FLAG),
            ("stopped", "Stopped", FLAG),
            ("status", "Status", WORD),
            ("number_of_laps", "NumberOfLaps", WORD),
            ("number_of_pit_stops", "NumberOfPitStops", WORD),
        ),
        parse.keyframe_lap_ms(F.col("c.BestLapTime.Value")).alias("best_lap_time_ms"),
        F.col("c.BestLapTime.Lap").try_cast(WORD).alias("best_lap"),
        parse.keyframe_lap_ms(F.col("c.LastLapTime.Value")).alias("last_lap_time_ms"),
        *_ranked("c.LastLapTime", "last_lap"),
        *[
            column
            for t in TRAPS
            for column in (
                F.col(f"c.Speeds.{t}.Value").alias(f"{t.lower()}_value"),
                *_ranked(f"c.Speeds.{t}", t.lower()),
            )
        ],
    )


def _snake(pascal: str) -> str:
    return "".join("_" + ch.lower() if ch.isupper() else ch for ch in pascal).lstrip("_")


def _sectors(docs: DataFrame) -> DataFrame:
    cars = _cars(docs, "Lines").withColumn("sectors", F.from_json("value", "Sectors STRING")["Sectors"])
    cars = cars.select(*ID, F.col("key").alias("car_number"), "sectors")
    return explode_object_items(cars, "sectors", "sector", "_k1", "value")


def timing_sectors(docs: DataFrame) -> DataFrame:
    """Final sector times per car; ``sector`` counts from 0 in list order."""
    keys = ["Stopped", "PreviousValue", "Value", "Status", "OverallFastest", "PersonalFastest"]
    return _child(_sectors(docs), *keys).select(
        *ID,
        "car_number",
        "sector",
        *_leaves(
            "c",
            ("stopped", "Stopped", FLAG),
            ("previous_value", "PreviousValue", REAL),
            ("value", "Value", REAL),
            ("status", "Status", WORD),
            ("overall_fastest", "OverallFastest", FLAG),
            ("personal_fastest", "PersonalFastest", FLAG),
        ),
    )


def timing_segments(docs: DataFrame) -> DataFrame:
    sectors = _sectors(docs).withColumn("segments", F.from_json("value", "Segments STRING")["Segments"])
    sectors = sectors.select(*ID, "car_number", "sector", "segments")
    segments = explode_object_items(sectors, "segments", "segment", "_k2", "value")
    return _child(segments, "Status").select(
        *ID, "car_number", "sector", "segment", *_leaves("c", ("status", "Status", WORD))
    )


STATS_SCHEMA = (
    "Line STRING, RacingNumber STRING, PersonalBestLapTime STRUCT<Value: STRING, Lap: STRING, Position: STRING>, "
    "BestSectors STRING, BestSpeeds STRUCT<"
    + ", ".join(f"{t}: STRUCT<Value: STRING, Position: STRING>" for t in TRAPS)
    + ">"
)


def _stats(docs: DataFrame) -> DataFrame:
    rows = _doc(docs, "Withheld STRING, SessionType STRING, Lines STRING").select(*ID, "p.*")
    rows = explode_object_items(rows, "Lines", "key_pos", "key", "value")
    return rows.withColumn("c", F.from_json("value", STATS_SCHEMA))


def timing_stats(docs: DataFrame) -> DataFrame:
    """Personal best and best speeds per car; empty text is null."""
    best = "c.PersonalBestLapTime"
    return _stats(docs).select(
        *ID,
        F.col("Withheld").try_cast(FLAG).alias("withheld"),
        F.col("SessionType").alias("session_type"),
        *_leaves("c", ("line", "Line", WORD), ("racing_number", "RacingNumber", TEXT)),
        *_leaves(best, ("best_lap", "Lap", WORD), ("best_position", "Position", WORD)),
        parse.lap_ms(F.col(f"{best}.Value")).alias("best_lap_time_ms"),
        *[
            column
            for t in TRAPS
            for column in _leaves(
                f"c.BestSpeeds.{t}", (f"{t.lower()}_value", "Value", REAL), (f"{t.lower()}_position", "Position", WORD)
            )
        ],
    )


def timing_stats_sectors(docs: DataFrame) -> DataFrame:
    rows = _stats(docs).select(*ID, F.col("c.RacingNumber").alias("racing_number"), F.col("c.BestSectors").alias("sectors"))
    rows = _child(explode_object_items(rows, "sectors", "sector", "_k", "value"), "Value", "Position")
    return rows.select(
        *ID, "racing_number", "sector", *_leaves("c", ("value", "Value", REAL), ("position", "Position", WORD))
    )


def timing_app(docs: DataFrame) -> DataFrame:
    """Stints per car; the cars may sit under ``Lines`` or at the top."""
    top = F.from_json("doc", "MAP<STRING,STRING>")
    lines = F.when(F.map_contains_key(top, "Lines"), F.element_at(top, "Lines")).otherwise(F.col("doc"))
    cars = _child(_cars(docs.withColumn("doc", lines), None), "RacingNumber", "Line", "GridPos", "Stints")
    cars = cars.select(*ID, "c.*").withColumnRenamed("Stints", "stints_json")
    stints = explode_object_items(cars, "stints_json", "stint", "_k", "value")
    keys = ["LapTime", "LapFlags", "Compound", "New", "TyresNotChanged", "TotalLaps", "StartLaps"]
    return _child(stints, *keys).select(
        *ID,
        F.col("RacingNumber").alias("racing_number"),
        F.col("Line").try_cast(WORD).alias("line"),
        F.col("GridPos").alias("grid_pos"),
        "stint",
        parse.keyframe_lap_ms(F.col("c.LapTime")).alias("lap_time_ms"),
        *_leaves(
            "c",
            ("lap_flags", "LapFlags", WORD),
            ("compound", "Compound", TEXT),
            ("new", "New", FLAG),
            ("tyres_not_changed", "TyresNotChanged", WORD),
            ("total_laps", "TotalLaps", WORD),
            ("start_laps", "StartLaps", WORD),
        ),
    )


def lap_series(docs: DataFrame) -> DataFrame:
    cars = _child(_cars(docs, None), "RacingNumber", "LapPosition").select(*ID, "c.*")
    laps = explode_items(cars, "LapPosition", "lap", "_k", "value")
    return laps.select(
        *ID,
        F.col("RacingNumber").try_cast(WORD).alias("racing_number"),
        "lap",
        F.col("value").try_cast(WORD).alias("position"),
    )


def tyre_stints(docs: DataFrame) -> DataFrame:
    rows = explode_map(_doc(docs, "Stints MAP<STRING,STRING>").select(*ID, "p.Stints"), "Stints", key="car")
    rows = explode_object_items(rows.withColumnRenamed("value", "items"), "items", "stint", "_k", "value")
    return _child(rows, "Compound", "New", "TyresNotChanged", "TotalLaps", "StartLaps").select(
        *ID,
        F.col("car").try_cast(WORD).alias("car_number"),
        "stint",
        *_leaves(
            "c",
            ("compound", "Compound", TEXT),
            ("new", "New", FLAG),
            ("tyres_not_changed", "TyresNotChanged", WORD),
            ("total_laps", "TotalLaps", WORD),
            ("start_laps", "StartLaps", WORD),
        ),
    )


def current_tyres(docs: DataFrame) -> DataFrame:
    return _child(_cars(docs, "Tyres"), "Compound", "New").select(
        *ID, F.col("key").alias("car_number"), *_leaves("c", ("compound", "Compound", TEXT), ("new", "New", FLAG))
    )


def _tracker_columns() -> list[Column]:
    return [
        *_leaves(
            "c",
            ("position", "Position", WORD),
            ("show_position", "ShowPosition", FLAG),
            ("racing_number", "RacingNumber", WORD),
        ),
        parse.keyframe_lap_ms(F.col("c.LapTime")).alias("lap_time_ms"),
        *_leaves("c", ("lap_state", "LapState", WORD)),
        *[_gap_or_zero(k) for k in ("DiffToAhead", "DiffToLeader")],
        *_leaves("c", ("overall_fastest", "OverallFastest", FLAG), ("personal_fastest", "PersonalFastest", FLAG)),
    ]


def _gap_or_zero(field: str) -> Column:
    """Gap text as a number; a missing gap is 0, an unreadable one null."""
    present = F.map_contains_key("fields", field)
    return F.when(present, parse.gap(_when_text("value", field, f"c.{field}"))).otherwise(F.lit(0.0)).alias(_snake(field))


TRACKER_KEYS = [
    "Position", "ShowPosition", "RacingNumber", "LapTime", "LapState", "DiffToAhead", "DiffToLeader",
    "OverallFastest", "PersonalFastest",
]


def driver_tracker(docs: DataFrame) -> DataFrame:
    rows = _child(_cars(docs, "Lines"), *TRACKER_KEYS).withColumn("fields", F.from_json("value", "MAP<STRING,STRING>"))
    return rows.select(*ID, F.col("key_pos").alias("line_index"), *_tracker_columns())


def top_three(docs: DataFrame) -> DataFrame:
    names = ["tla", "broadcast_name", "full_name", "team", "team_colour"]
    rows = _child(_cars(docs, "Lines"), *TRACKER_KEYS, *map(_pascal, names))
    rows = rows.withColumn("fields", F.from_json("value", "MAP<STRING,STRING>"))
    return rows.select(
        *ID,
        F.col("key_pos").alias("line_index"),
        *_tracker_columns(),
        *_leaves("c", *((n, _pascal(n), TEXT) for n in names)),
    )


def driver_list(docs: DataFrame) -> DataFrame:
    columns = [
        ("racing_number", WORD),
        ("broadcast_name", TEXT),
        ("full_name", TEXT),
        ("tla", TEXT),
        ("line", WORD),
        ("team_name", TEXT),
        ("team_colour", TEXT),
        ("first_name", TEXT),
        ("last_name", TEXT),
        ("reference", TEXT),
        ("headshot_url", TEXT),
        ("public_id_right", TEXT),
        ("country_code", TEXT),
    ]
    wanted = [(n, _pascal(n), t) for n, t in columns]
    return _child(_cars(docs, None), *(k for _, k, _ in wanted)).select(
        *ID, F.col("key").alias("car_number"), *_leaves("c", *wanted)
    )


def driver_race_info(docs: DataFrame) -> DataFrame:
    keys = ["RacingNumber", "Position", "Gap", "Interval", "PitStops", "Catching", "OvertakeState", "IsOut"]
    return _child(_cars(docs, None), *keys).select(
        *ID,
        *_leaves("c", ("racing_number", "RacingNumber", TEXT), ("position", "Position", TEXT)),
        F.coalesce("c.Gap", F.lit("")).alias("gap"),
        F.coalesce("c.Interval", F.lit("")).alias("interval"),
        *_leaves(
            "c",
            ("pit_stops", "PitStops", WORD),
            ("catching", "Catching", WORD),
            ("overtake_state", "OvertakeState", WORD),
        ),
        F.coalesce(F.col("c.IsOut").try_cast(FLAG), F.lit(False)).alias("is_out"),
    )


def championship(docs: DataFrame) -> DataFrame:
    """Standings now and predicted; ``entry_type`` tells drivers from teams."""
    keys = ["CurrentPosition", "PredictedPosition", "CurrentPoints", "PredictedPoints"]

    def side(field: str, name: str, identity: str) -> DataFrame:
        return _child(_cars(docs, field), *keys, identity).select(
            *ID,
            F.lit(name).alias("entry_type"),
            F.col(f"c.{identity}").alias("entry_key"),
            *_leaves(
                "c",
                ("current_position", "CurrentPosition", WORD),
                ("predicted_position", "PredictedPosition", WORD),
                ("current_points", "CurrentPoints", REAL),
                ("predicted_points", "PredictedPoints", REAL),
            ),
        )

    return side("Drivers", "driver", "RacingNumber").unionByName(side("Teams", "team", "TeamName"))


def race_control(docs: DataFrame) -> DataFrame:
    """Messages with the fields their category has; an unknown category keeps the common ones."""
    rows = _doc(docs, "Messages STRING").select(*ID, "p.Messages")
    rows = explode_object_items(rows, "Messages", "message_no", "_k", "value")
    keys = ["Utc", "Lap", "Message", "Category", "Flag", "Scope", "Sector", "RacingNumber", "Status", "Mode"]
    category = F.col("c.Category")

    def of(value: Column, *kinds: str) -> Column:
        return F.when(category.isin(*kinds), value)

    return _child(rows, *keys).select(
        *ID,
        "message_no",
        parse.utc(F.col("c.Utc")).alias("utc"),
        F.col("c.Lap").try_cast(WORD).alias("lap"),
        F.col("c.Message").alias("message"),
        category.alias("category"),
        of(F.col("c.Flag"), "Flag").alias("flag"),
        of(F.col("c.Scope"), "Flag").alias("scope"),
        of(F.col("c.Sector").try_cast(WORD), "Flag").alias("sector"),
        of(F.col("c.RacingNumber"), "Flag").alias("racing_number"),
        of(F.col("c.Status"), "SafetyCar", "Drs").alias("status"),
        of(parse.safety_car_mode(F.col("c.Mode")), "SafetyCar").alias("mode"),
    )


def overtakes(docs: DataFrame) -> DataFrame:
    rows = _doc(docs, "Overtakes STRING").select(*ID, "p.Overtakes")
    rows = explode_items(rows, "Overtakes", "key_pos", "car", "events")
    rows = explode_object_items(rows, "events", "event_no", "_k", "value")
    rows = rows.withColumn("c", F.from_json("value", "MAP<STRING,STRING>"))
    return rows.select(
        *ID,
        F.col("car").alias("racing_number"),
        "event_no",
        parse.utc(F.coalesce(F.element_at("c", "Timestamp"), F.element_at("c", "timestamp"))).alias("timestamp"),
        F.coalesce(F.element_at("c", "Count"), F.element_at("c", "count")).try_cast(WORD).alias("count"),
    )


def _single(docs: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    wanted = [(n, _pascal(n), t) for n, t in columns]
    return _doc(docs, _texts(*(k for _, k, _ in wanted))).select(*ID, *_leaves("p", *wanted))


def pit_stop(docs: DataFrame) -> DataFrame:
    return _single(docs, [("racing_number", WORD), ("pit_stop_time", REAL), ("pit_lane_time", REAL), ("lap", WORD)])


def pit_lane_times(docs: DataFrame) -> DataFrame:
    rows = explode_map(_doc(docs, "PitTimes MAP<STRING,STRING>").select(*ID, "p.PitTimes"), "PitTimes")
    return rows.select(*ID, "key", "value")


def weather(docs: DataFrame) -> DataFrame:
    return _single(docs, WEATHER)


def session_info(docs: DataFrame) -> DataFrame:
    rows = _doc(docs, feeds.SESSION_INFO_SCHEMA)
    return rows.select(*ID, *feeds.session_info_columns()).select(
        *ID,
        "session_key",
        "session_type",
        "session_number",
        "session_name",
        parse.utc(F.col("start_date")).alias("start_date"),
        parse.utc(F.col("end_date")).alias("end_date"),
        parse.gmt_offset_s(F.col("gmt_offset")).alias("gmt_offset_s"),
        "path",
        "meeting_key",
        "meeting_name",
        "meeting_official_name",
        "meeting_location",
        "country_key",
        "country_code",
        "country_name",
        "circuit_key",
        "circuit_short_name",
        "archive_status",
    )


def session_laps(docs: DataFrame) -> DataFrame:
    rows = _child(_cars(docs, "Series"), "Utc", "Lap")
    return rows.select(*ID, parse.utc(F.col("c.Utc")).alias("utc"), *_leaves("c", ("lap", "Lap", WORD)))


def session_statuses(docs: DataFrame) -> DataFrame:
    rows = _child(_cars(docs, "StatusSeries"), "Utc", "TrackStatus", "SessionStatus")
    return rows.select(
        *ID,
        parse.utc(F.col("c.Utc")).alias("utc"),
        *_leaves("c", ("track_status", "TrackStatus", TEXT), ("session_status", "SessionStatus", TEXT)),
    )


def track_status(docs: DataFrame) -> DataFrame:
    return _single(docs, [("status", WORD), ("message", TEXT)])


def content_streams(docs: DataFrame) -> DataFrame:
    names = ["type", "name", "language", "uri", "path", "utc"]
    return _child(_cars(docs, "Streams"), *map(_pascal, names)).select(*ID, *_leaves("c", *((n, _pascal(n), TEXT) for n in names)))


def pit_stop_series(docs: DataFrame) -> DataFrame:
    rows = explode_map(_doc(docs, "PitTimes MAP<STRING,STRING>").select(*ID, "p.PitTimes"), "PitTimes", key="car")
    rows = explode_object_items(rows.withColumnRenamed("value", "stops"), "stops", "stop", "_k", "value")
    rows = _child(rows, "Timestamp", "PitStop")
    rows = rows.withColumn("s", F.from_json("c.PitStop", _texts("RacingNumber", "PitStopTime", "PitLaneTime", "Lap")))
    return rows.select(
        *ID,
        F.col("car").try_cast(WORD).alias("car_number"),
        "stop",
        parse.utc(F.col("c.Timestamp")).alias("utc"),
        *_leaves(
            "s",
            ("racing_number", "RacingNumber", WORD),
            ("pit_stop_time", "PitStopTime", REAL),
            ("pit_lane_time", "PitLaneTime", REAL),
            ("lap", "Lap", WORD),
        ),
    )


def weather_series(docs: DataFrame) -> DataFrame:
    rows = _cars(docs, "Series")
    rows = rows.withColumn("c", F.from_json("value", f"Timestamp STRING, Weather STRUCT<{feeds._colon(WEATHER)}>"))
    return rows.select(
        *ID,
        parse.utc(F.col("c.Timestamp")).alias("timestamp"),
        *_leaves("c.Weather", *((n, _pascal(n), t) for n, t in WEATHER)),
    )


def session_status(docs: DataFrame) -> DataFrame:
    return _single(docs, [("status", TEXT), ("started", TEXT)])


def archive_status(docs: DataFrame) -> DataFrame:
    return _single(docs, [("status", TEXT)])


def lap_count(docs: DataFrame) -> DataFrame:
    return _single(docs, [("current_lap", WORD), ("total_laps", WORD)])


def heartbeat(docs: DataFrame) -> DataFrame:
    return _single(docs, [("utc", TEXT)]).select(*ID, parse.utc(F.col("utc")).alias("utc"))


def extrapolated_clock(docs: DataFrame) -> DataFrame:
    rows = _single(docs, [("utc", TEXT), ("remaining", TEXT), ("extrapolating", FLAG)])
    return rows.select(
        *ID,
        parse.utc(F.col("utc")).alias("utc"),
        parse.remaining_ms(F.col("remaining")).alias("remaining_ms"),
        "extrapolating",
    )


def tla_rcm(docs: DataFrame) -> DataFrame:
    rows = _single(docs, [("timestamp", TEXT), ("message", TEXT)])
    return rows.select(*ID, parse.utc(F.col("timestamp")).alias("timestamp"), "message")


# Keyframe tables by feed; a feed with nested lists has one table per level.
KEYFRAMES = {
    "CarData": {"car_data": car_data},
    "TimingDataF1": {"lines": timing_lines, "sectors": timing_sectors, "segments": timing_segments},
    "TimingStats": {"lines": timing_stats, "sectors": timing_stats_sectors},
    "TimingAppData": {"stints": timing_app},
    "LapSeries": {"laps": lap_series},
    "TyreStintSeries": {"stints": tyre_stints},
    "CurrentTyres": {"tyres": current_tyres},
    "DriverTracker": {"lines": driver_tracker},
    "DriverList": {"drivers": driver_list},
    "DriverRaceInfo": {"drivers": driver_race_info},
    "ChampionshipPrediction": {"standings": championship},
    "RaceControlMessages": {"messages": race_control},
    "OvertakeSeries": {"overtakes": overtakes},
    "PitStop": {"stop": pit_stop},
    "PitLaneTimeCollection": {"times": pit_lane_times},
    "WeatherData": {"weather": weather},
    "SessionInfo": {"session": session_info},
    "SessionData": {"laps": session_laps, "statuses": session_statuses},
    "TrackStatus": {"status": track_status},
    "ContentStreams": {"streams": content_streams},
    "Position": {"positions": position},
    "TopThree": {"lines": top_three},
    "PitStopSeries": {"stops": pit_stop_series},
    "WeatherDataSeries": {"weather": weather_series},
    "SessionStatus": {"status": session_status},
    "ArchiveStatus": {"status": archive_status},
    "LapCount": {"laps": lap_count},
    "Heartbeat": {"heartbeat": heartbeat},
    "ExtrapolatedClock": {"clock": extrapolated_clock},
    "TlaRcm": {"message": tla_rcm},
}
