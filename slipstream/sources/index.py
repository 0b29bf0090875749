"""Index documents: root (years), season (meetings and sessions), session (feeds)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.functions import parse

# Feed names a session index may hold that have a place of their own.
KNOWN_FEEDS = [
    "SessionInfo", "ArchiveStatus", "SessionData", "SessionStatus", "ContentStreams", "AudioStreams",
    "Heartbeat", "ExtrapolatedClock", "TimingData", "TimingDataF1", "TimingAppData", "TimingStats",
    "LapSeries", "LapCount", "TopThree", "TyreStintSeries", "CurrentTyres", "CarData.z", "Position.z",
    "RaceControlMessages", "TlaRcm", "TrackStatus", "TeamRadio", "WeatherData", "WeatherDataSeries",
    "DriverList", "PitLaneTimeCollection", "ChampionshipPrediction", "DriverScore", "DriverRaceInfo",
]

# Session names and the other spellings they go by.
SESSION_NAMES = [
    "Practice 1", "Practice 2", "Practice 3", "Qualifying", "Sprint Shootout", "Sprint", "Race",
    "High Speed Track Test",
]
SESSION_ALIASES = {
    "sprint qualifying": "sprint shootout",
    "day 1": "practice 1",
    "day 2": "practice 2",
    "day 3": "practice 3",
    "practice": "practice 1",
}

SEASON_SCHEMA = """
Year INT,
Meetings ARRAY<STRUCT<
  Key INT, Code STRING, Number INT, Location STRING, OfficialName STRING, Name STRING,
  Country STRUCT<Key INT, Code STRING, Name STRING>,
  Circuit STRUCT<Key INT, ShortName STRING>,
  Sessions ARRAY<STRUCT<
    Key INT, Type STRING, Number INT, Name STRING, StartDate STRING, EndDate STRING,
    GmtOffset STRING, Path STRING>>>>
"""


def session_name(c: Column) -> Column:
    """Canonical session name for any accepted spelling, else null."""
    key = parse.folded(c)
    for alias, name in SESSION_ALIASES.items():
        key = F.when(parse.folded(c) == alias, F.lit(name)).otherwise(key)
    chosen = F.lit(None).cast("string")
    for name in SESSION_NAMES:
        chosen = F.when(key == name.lower(), F.lit(name)).otherwise(chosen)
    return chosen


def years(docs: DataFrame) -> DataFrame:
    """Root index documents to ``year, path``."""
    rows = docs.select(F.explode(F.from_json("doc", "Years ARRAY<STRUCT<Year: INT, Path: STRING>>")["Years"]).alias("y"))
    return rows.select(F.col("y.Year").alias("year"), F.col("y.Path").alias("path"))


def _meetings(docs: DataFrame) -> DataFrame:
    season = docs.select(F.from_json("doc", SEASON_SCHEMA).alias("s"))
    return season.select(F.col("s.Year").alias("year"), F.posexplode("s.Meetings").alias("meeting_pos", "m"))


def meetings(docs: DataFrame) -> DataFrame:
    """Season index documents to one row per meeting."""
    return _meetings(docs).select(
        "year",
        "meeting_pos",
        F.col("m.Key").alias("meeting_key"),
        F.col("m.Code").alias("code"),
        F.col("m.Number").alias("number"),
        F.col("m.Name").alias("name"),
        F.col("m.Location").alias("location"),
        F.col("m.OfficialName").alias("official_name"),
        F.col("m.Country.Key").alias("country_key"),
        F.col("m.Country.Code").alias("country_code"),
        F.col("m.Country.Name").alias("country_name"),
        F.col("m.Circuit.Key").alias("circuit_key"),
        F.col("m.Circuit.ShortName").alias("circuit_short_name"),
    )


def sessions(docs: DataFrame) -> DataFrame:
    """Season index documents to one row per session, with its address taken apart."""
    rows = _meetings(docs).select(
        "year", "meeting_pos", F.col("m.Key").alias("meeting_key"), F.posexplode("m.Sessions").alias("session_pos", "s")
    )
    return rows.select(
        "year",
        "meeting_pos",
        "meeting_key",
        "session_pos",
        F.col("s.Key").alias("session_key"),
        F.col("s.Type").alias("type"),
        F.col("s.Number").alias("number"),
        F.col("s.Name").alias("raw_name"),
        session_name(F.col("s.Name")).alias("name"),
        parse.utc(F.col("s.StartDate")).alias("start_date"),
        parse.utc(F.col("s.EndDate")).alias("end_date"),
        parse.gmt_offset_s(F.col("s.GmtOffset")).alias("gmt_offset_s"),
        F.col("s.Path").alias("path"),
    ).select("*", *address(F.col("path")))


def address(path: Column) -> list[Column]:
    parts = F.split(path, "/")
    names = ["path_year", "meeting_folder", "session_folder"]
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def session_feeds(docs: DataFrame) -> DataFrame:
    """Session index documents to one row per feed offered; feeds without a known name are flagged."""
    paths = "MAP<STRING,STRUCT<KeyFramePath:STRING,StreamPath:STRING>>"
    feeds = F.when(
        F.get_json_object("doc", "$.Feeds").isNotNull(), F.from_json("doc", f"Feeds {paths}")["Feeds"]
    ).otherwise(F.from_json("doc", paths))
    rows = docs.select("session_id", F.explode(feeds).alias("feed", "f"))
    return rows.select(
        "session_id",
        "feed",
        F.col("f.KeyFramePath").alias("keyframe_path"),
        F.col("f.StreamPath").alias("stream_path"),
        F.contains("f.KeyFramePath", F.lit(".z.")).alias("compressed"),
        F.col("feed").isin(KNOWN_FEEDS).alias("known"),
    )


def available_feeds(offered: DataFrame) -> DataFrame:
    """The known feeds of each session."""
    return offered.filter("known").select("session_id", "feed", "compressed")


def missing_feeds(requested: DataFrame, offered: DataFrame) -> DataFrame:
    """Requested ``session_id, feed`` pairs that the sessions do not offer."""
    return requested.join(offered, ["session_id", "feed"], "left_anti")
