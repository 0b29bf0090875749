"""One query per keyframe: a document per day from the cars' latest states, flattened again."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.operators import keyframes as kf
from slipstream.operators import quality
from slipstream.plans.feed_queries import (
    CATEGORY,
    COMPOUND,
    COMPOUND_SQL,
    INFO,
    LAP_MS,
    LAP_TEXT,
    MESSAGE,
    READING,
    READING_SQL,
    Query,
)
from slipstream.plans.lines import LATEST_SQL, ROUNDS_SQL, STATES_SQL, car_documents, deflate_raw, session_documents, template
from slipstream.sources import archive

QUERIES: dict[str, Query] = {}


def _cars(
    name: str, flatten: Callable[[DataFrame], DataFrame], child: str, before: str, after: str, sql: str, every: bool = False
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten(archive.decode_documents(car_documents(spark, sf_dir, child, before, after, every)))

    QUERIES[name] = Query(run, f"WITH {ROUNDS_SQL if every else STATES_SQL} {sql}")


def _all(name: str, flatten: Callable[[DataFrame], DataFrame], child: str, before: str, after: str, sql: str) -> None:
    """A keyframe that lists everything that happened, from every event."""
    _cars(name, flatten, child, before, after, sql, every=True)


def _one(name: str, flatten: Callable[[DataFrame], DataFrame], document: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten(archive.decode_documents(session_documents(spark, sf_dir, document)))

    QUERIES[name] = Query(run, f"WITH {LATEST_SQL} {sql}")


# Telemetry

CAR_STATE = template(
    '{"Utc":"${utc6}Z","Cars":{"${car}":{"Channels":{"0":${k * 100},"2":"${k}","3":${k % 9},"4":${k % 100},"5":0,"45":${k % 15}}},'
    '"${car + 20}":{"Channels":{}}}}'
)
_all(
    "kf_car_data",
    kf.car_data,
    CAR_STATE,
    '{"Entries":[',
    "]}",
    """SELECT session_id, utc6 || 'Z' AS utc, car::VARCHAR AS car_number, k * 100 AS rpm, k AS speed, k % 9 AS gear,
         k % 100 AS throttle, 0 AS brake, k % 15 AS drs FROM st
       UNION ALL SELECT session_id, utc6 || 'Z', (car + 20)::VARCHAR, 0, 0, 0, 0, 0, NULL FROM st""",
)


def _car_data_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry documents compressed as in ``.z.json`` files, and in quotes."""
    docs = car_documents(spark, sf_dir, CAR_STATE, '{"Entries":[', "]}", every=True)
    packed = F.base64(deflate_raw(F.replace("doc", F.lit("\ufeff"), F.lit(""))))
    return kf.car_data(archive.decode_documents(docs.withColumn("doc", F.concat(F.lit('\ufeff"'), packed, F.lit('"'))), compressed=True))


QUERIES["kf_car_data_z"] = Query(_car_data_z, QUERIES["kf_car_data"].sql)
_all(
    "kf_position",
    kf.position,
    template('{"Timestamp":"${utc6}Z","Entries":{"${car}":{"Status":"OnTrack","X":${k * 10},"Y":${v},"Z":${-k}}}}'),
    '{"Position":[',
    "]}",
    """SELECT session_id, utc6 || 'Z' AS utc, car::SMALLINT AS racing_number, 'OnTrack' AS status, (k * 10)::DOUBLE AS x,
         v AS y, (-k)::DOUBLE AS z FROM st""",
)

# Timing

TRAP = '{"Value":"${k + 200}","Status":${k % 3},"OverallFastest":${k % 2 = 0},"PersonalFastest":false}'
SECTOR = (
    '{"Stopped":false,"PreviousValue":"${v}","Segments":[{"Status":2048},{"Status":${k}}],"Value":"","Status":0,'
    '"OverallFastest":${k % 2 = 0},"PersonalFastest":true}'
)
LINE = template(
    '"${car}":{"GapToLeader":"${if(k % 3 = 0, \'\', if(k % 3 = 1, concat(\'+\', v), concat(k, \'L\')))}",'
    '"IntervalToPositionAhead":{"Value":"+${v}","Catching":${k % 2 = 0}},"Line":${car},"Position":"${car}","ShowPosition":true,'
    '"RacingNumber":"${car}","Retired":${k % 7 = 0},"InPit":false,"PitOut":${k % 5 = 0},"Stopped":false,"Status":${k * 16},'
    '"NumberOfLaps":${k % 70},"NumberOfPitStops":${k % 4},"Sectors":[' + SECTOR + ",null," + SECTOR + '],'
    '"Speeds":{"I1":' + TRAP + ',"I2":' + TRAP + ',"FL":{"Value":""},"ST":' + TRAP + "},"
    '"BestLapTime":{"Value":"${if(et = \'error\', \'\', if(et = \'signup\', \'slow\', ' + LAP_TEXT + '))}","Lap":${k % 70}},'
    '"LastLapTime":{"Value":"${' + LAP_TEXT + '}","Status":0,"OverallFastest":false,"PersonalFastest":${k % 2 = 0}}}'
)


def _trap_sql(name: str) -> str:
    return f"""(k + 200)::VARCHAR AS {name}_value, k % 3 AS {name}_status, k % 2 = 0 AS {name}_overall_fastest,
               false AS {name}_personal_fastest"""


TIMING_BEFORE, TIMING_AFTER = '{"Withheld":false,"Lines":{', "}}"
_cars(
    "kf_timing_lines",
    kf.timing_lines,
    LINE,
    TIMING_BEFORE,
    TIMING_AFTER,
    f"""SELECT session_id, car::VARCHAR AS car_number, car::VARCHAR AS racing_number, car::VARCHAR AS position, car AS line,
          true AS show_position, NULL::DOUBLE AS time_diff_to_fastest, NULL::DOUBLE AS time_diff_to_position_ahead,
          CASE k % 3 WHEN 1 THEN v WHEN 2 THEN (-k)::DOUBLE END AS gap_to_leader, '+' || v AS interval_value,
          k % 2 = 0 AS interval_catching, k % 7 = 0 AS retired, false AS in_pit, k % 5 = 0 AS pit_out, false AS stopped,
          k * 16 AS status, k % 70 AS number_of_laps, k % 4 AS number_of_pit_stops,
          CASE et WHEN 'error' THEN 0::BIGINT WHEN 'signup' THEN NULL ELSE {LAP_MS} END AS best_lap_time_ms,
          k % 70 AS best_lap, {LAP_MS} AS last_lap_time_ms, 0 AS last_lap_status, false AS last_lap_overall_fastest,
          k % 2 = 0 AS last_lap_personal_fastest, {_trap_sql("i1")}, {_trap_sql("i2")}, '' AS fl_value,
          NULL::INTEGER AS fl_status, NULL::BOOLEAN AS fl_overall_fastest, NULL::BOOLEAN AS fl_personal_fastest,
          {_trap_sql("st")} FROM st""",
)
_cars(
    "kf_timing_sectors",
    kf.timing_sectors,
    LINE,
    TIMING_BEFORE,
    TIMING_AFTER,
    """SELECT session_id, car::VARCHAR AS car_number, s::INTEGER AS sector, false AS stopped, v AS previous_value,
         NULL::DOUBLE AS value, 0 AS status, k % 2 = 0 AS overall_fastest, true AS personal_fastest
       FROM st CROSS JOIN (VALUES (0), (2)) AS t(s)""",
)
_cars(
    "kf_timing_segments",
    kf.timing_segments,
    LINE,
    TIMING_BEFORE,
    TIMING_AFTER,
    """SELECT session_id, car::VARCHAR AS car_number, s::INTEGER AS sector, g::INTEGER AS segment,
         CASE g WHEN 0 THEN 2048 ELSE k END AS status FROM st CROSS JOIN (VALUES (0), (2)) AS t(s) CROSS JOIN (VALUES (0), (1)) AS u(g)""",
)
STATS = template(
    '"${car}":{"Line":${car},"RacingNumber":"${car}","PersonalBestLapTime":{"Lap":${k % 70},"Position":${k % 20},'
    '"Value":"${if(et = \'error\', \'\', ' + LAP_TEXT + ')}"},'
    '"BestSectors":[{"Position":${k % 20},"Value":"${v}"},{"Value":""}],'
    '"BestSpeeds":{"I1":{"Position":1,"Value":"${k}"},"I2":{"Value":""},"FL":{"Position":3,"Value":"${k + 1}"},"ST":{"Position":4,"Value":"${k + 2}"}}}'
)
STATS_BEFORE = '{"Withheld":false,"SessionType":"Race","Lines":{'
_cars(
    "kf_timing_stats",
    kf.timing_stats,
    STATS,
    STATS_BEFORE,
    "}}",
    f"""SELECT session_id, false AS withheld, 'Race' AS session_type, car AS line, car::VARCHAR AS racing_number, k % 70 AS best_lap,
          k % 20 AS best_position, CASE WHEN et <> 'error' THEN {LAP_MS} END AS best_lap_time_ms, k::DOUBLE AS i1_value, 1 AS i1_position,
          NULL::DOUBLE AS i2_value, NULL::INTEGER AS i2_position, (k + 1)::DOUBLE AS fl_value, 3 AS fl_position,
          (k + 2)::DOUBLE AS st_value, 4 AS st_position FROM st""",
)
_cars(
    "kf_timing_stats_sectors",
    kf.timing_stats_sectors,
    STATS,
    STATS_BEFORE,
    "}}",
    """SELECT session_id, car::VARCHAR AS racing_number, s::INTEGER AS sector, CASE s WHEN 0 THEN v END AS value,
         CASE s WHEN 0 THEN k % 20 END AS position FROM st CROSS JOIN (VALUES (0), (1)) AS t(s)""",
)
STINT = (
    '{"LapTime":"${' + LAP_TEXT + '}","LapFlags":1,"Compound":"${' + COMPOUND + '}","New":"${if(k % 2 = 0, \'true\', \'false\')}",'
    '"TyresNotChanged":"0","TotalLaps":${k},"StartLaps":${k % 5}}'
)
APP_SQL = f"""SELECT session_id, car::VARCHAR AS racing_number, car AS line, (k % 20)::VARCHAR AS grid_pos, 0 AS stint,
  {LAP_MS} AS lap_time_ms, 1 AS lap_flags, {COMPOUND_SQL} AS compound, k % 2 = 0 AS "new", 0 AS tyres_not_changed,
  k AS total_laps, k % 5 AS start_laps FROM st
  UNION ALL SELECT session_id, car::VARCHAR, car, (k % 20)::VARCHAR, 1, NULL, NULL, 'SOFT', NULL, NULL, k + 1, NULL FROM st"""
APP = template(
    '"${car}":{"RacingNumber":"${car}","Line":${car},"GridPos":"${k % 20}","Stints":['
    + STINT
    + ',{"Compound":"SOFT","TotalLaps":${k + 1}}]}'
)
_all("kf_timing_app", kf.timing_app, APP, '{"Lines":{', "}}", APP_SQL)
_all("kf_timing_app_bare", kf.timing_app, APP, "{", "}", APP_SQL)
_all(
    "kf_lap_series",
    kf.lap_series,
    template('"${car}":{"RacingNumber":"${car}","LapPosition":["${k % 20}",${(k + 1) % 20}]}'),
    "{",
    "}",
    """SELECT session_id, car AS racing_number, l::INTEGER AS lap, (k + l) % 20 AS position
       FROM st CROSS JOIN (VALUES (0), (1)) AS t(l)""",
)
_all(
    "kf_tyre_stints",
    kf.tyre_stints,
    template('"${car}":[' + STINT + ',{"Compound":"SOFT","New":false,"TotalLaps":"${k + 1}"}]'),
    '{"Stints":{',
    "}}",
    f"""SELECT session_id, car AS car_number, 0 AS stint, {COMPOUND_SQL} AS compound, k % 2 = 0 AS "new", 0 AS tyres_not_changed,
          k AS total_laps, k % 5 AS start_laps FROM st
        UNION ALL SELECT session_id, car, 1, 'SOFT', false, NULL, k + 1, NULL FROM st""",
)
TYRES = template('"${car}":{"Compound":"${' + COMPOUND + '}","New":${if(k % 10 = 0, \'"odd"\', CAST(k % 2 = 0 AS STRING))}}')
_cars(
    "kf_current_tyres",
    kf.current_tyres,
    TYRES,
    '{"Tyres":{',
    "}}",
    f"""SELECT session_id, car::VARCHAR AS car_number, {COMPOUND_SQL} AS compound,
          CASE WHEN k % 10 <> 0 THEN k % 2 = 0 END AS "new" FROM st""",
)
TRACKER = (
    '"Position":"${car}","ShowPosition":true,"RacingNumber":"${car}","LapTime":"${if(et = \'error\', \'\', ' + LAP_TEXT + ')}",'
    '"LapState":${k},${if(k % 2 = 0, concat(\'"DiffToAhead":"+\', v, \'",\'), \'\')}"DiffToLeader":"${if(k % 3 = 0, \'\', concat(k, \'L\'))}",'
    '"OverallFastest":${k % 2 = 0},"PersonalFastest":false'
)
TRACKER_SQL = f"""pos::INTEGER AS line_index, car AS position, true AS show_position, car AS racing_number,
  CASE WHEN et = 'error' THEN 0::BIGINT ELSE {LAP_MS} END AS lap_time_ms, k AS lap_state,
  CASE WHEN k % 2 = 0 THEN v ELSE 0 END AS diff_to_ahead, CASE WHEN k % 3 <> 0 THEN (-k)::DOUBLE END AS diff_to_leader,
  k % 2 = 0 AS overall_fastest, false AS personal_fastest"""
_cars(
    "kf_driver_tracker",
    kf.driver_tracker,
    template("{" + TRACKER + "}"),
    '{"Withheld":false,"Lines":[',
    "]}",
    f"SELECT session_id, {TRACKER_SQL} FROM si",
)
_cars(
    "kf_top_three",
    kf.top_three,
    template(
        "{" + TRACKER + ',"Tla":"T${car}","BroadcastName":"B ${car}","FullName":"F ${car}","Team":"Team ${car % 10}","TeamColour":"00${car}"}'
    ),
    '{"Withheld":false,"Lines":[',
    "]}",
    f"""SELECT session_id, {TRACKER_SQL}, 'T' || car AS tla, 'B ' || car AS broadcast_name, 'F ' || car AS full_name,
          'Team ' || (car % 10) AS team, '00' || car AS team_colour FROM si""",
)

# Drivers and standings

_cars(
    "kf_driver_list",
    kf.driver_list,
    "concat("
    + template(
        '"${car}":{"RacingNumber":"${car}","BroadcastName":"B ${car}","FullName":"F ${car}","Tla":"T${car}","Line":${k},'
        '"TeamName":"Team ${car % 10}","TeamColour":"00${car}","FirstName":"A","LastName":"Z${car}","Reference":"R${k}"'
    )
    + ", CASE WHEN k % 2 = 0 THEN "
    + template(',"HeadshotUrl":"h://${k}","CountryCode":"C"')
    + " ELSE '' END, '}')",
    "{",
    "}",
    """SELECT session_id, car::VARCHAR AS car_number, car AS racing_number, 'B ' || car AS broadcast_name, 'F ' || car AS full_name,
         'T' || car AS tla, k AS line, 'Team ' || (car % 10) AS team_name, '00' || car AS team_colour, 'A' AS first_name,
         'Z' || car AS last_name, 'R' || k AS reference, CASE WHEN k % 2 = 0 THEN 'h://' || k END AS headshot_url,
         NULL::VARCHAR AS public_id_right, CASE WHEN k % 2 = 0 THEN 'C' END AS country_code FROM st""",
)
_cars(
    "kf_driver_race_info",
    kf.driver_race_info,
    f"""CASE WHEN k % 2 = 0 THEN {template(
        '"${car}":{"RacingNumber":"${car}","Position":"${k % 20}","Gap":"+${v}","Interval":"+1.0","PitStops":${k % 4},'
        '"Catching":${k % 3},"OvertakeState":${k % 3},"IsOut":true}'
    )} ELSE {template('"${car}":{"RacingNumber":"${car}","Position":"${k % 20}"}')} END""",
    "{",
    "}",
    """SELECT session_id, car::VARCHAR AS racing_number, (k % 20)::VARCHAR AS position, CASE WHEN k % 2 = 0 THEN '+' || v ELSE '' END AS gap,
         CASE WHEN k % 2 = 0 THEN '+1.0' ELSE '' END AS "interval", CASE WHEN k % 2 = 0 THEN k % 4 END AS pit_stops,
         CASE WHEN k % 2 = 0 THEN k % 3 END AS catching, CASE WHEN k % 2 = 0 THEN k % 3 END AS overtake_state, k % 2 = 0 AS is_out FROM st""",
)
STANDING = '"CurrentPosition":${k % 20},"PredictedPosition":${(k + 1) % 20},"CurrentPoints":${v},"PredictedPoints":"${v}"}'
_cars(
    "kf_championship",
    kf.championship,
    template('"${car}":{"RacingNumber":"${car}","TeamName":"Team ${car}",' + STANDING),
    '{"Teams":{"Alpha":{"TeamName":"Alpha","CurrentPoints":1.5}},"Drivers":{',
    "}}",
    """SELECT session_id, 'driver' AS entry_type, car::VARCHAR AS entry_key, k % 20 AS current_position, (k + 1) % 20 AS predicted_position,
         v AS current_points, v AS predicted_points FROM st
       UNION ALL SELECT DISTINCT session_id, 'team', 'Alpha', NULL, NULL, 1.5::DOUBLE, NULL FROM st""",
)
RCM_SQL = f"""SELECT session_id, pos::INTEGER AS message_no, ts AS utc, k AS lap, 'M ' || k AS message, {CATEGORY} AS category,
  CASE WHEN et = 'view' THEN CASE WHEN k % 10 = 0 THEN 'PINK' ELSE 'RED' END END AS flag,
  CASE WHEN et = 'view' THEN 'Track' END AS scope, CASE WHEN et = 'view' THEN k % 20 END AS sector,
  CASE WHEN et = 'view' THEN car::VARCHAR END AS racing_number,
  CASE WHEN et IN ('click', 'purchase') THEN CASE WHEN k % 3 = 0 THEN 'DEPLOYED' ELSE 'ENABLED' END END AS status,
  CASE WHEN et = 'click' THEN CASE WHEN k % 2 = 0 THEN 'VIRTUAL SAFETY CAR' ELSE 'SAFETY CAR' END END AS mode FROM si"""
_all("kf_rcm", kf.race_control, template(MESSAGE), '{"Messages":[', "]}", RCM_SQL)
_all(
    "kf_overtakes",
    kf.overtakes,
    template('"${car}":[{"Timestamp":"${utc6}7Z","Count":${k}},{"Count":1}]'),
    '{"Overtakes":{',
    "}}",
    """SELECT session_id, car::VARCHAR AS racing_number, 0 AS event_no, ts AS "timestamp", k AS count FROM st
       UNION ALL SELECT session_id, car::VARCHAR, 1, NULL, 1 FROM st""",
)

# Pit lane

_one(
    "kf_pit_stop",
    kf.pit_stop,
    template('{"RacingNumber":"${car}","PitStopTime":"${v}","PitLaneTime":"${k}.5","Lap":"${k % 60}"}'),
    """SELECT session_id, car AS racing_number, v AS pit_stop_time, k + 0.5::DOUBLE AS pit_lane_time, k % 60 AS lap FROM last""",
)
_all(
    "kf_pit_lane_times",
    kf.pit_lane_times,
    template('"${car}":{"Duration":"${v}","Lap":${k}}'),
    '{"PitTimes":{',
    ',"_deleted":["1"]}}',
    """SELECT session_id, car::VARCHAR AS key, '{"Duration":"' || v || '","Lap":' || k || '}' AS value FROM st
       UNION ALL SELECT DISTINCT session_id, '_deleted', '["1"]' FROM st""",
)
STOP = '{"Timestamp":"${utc6}7Z","PitStop":{"RacingNumber":"${car}","PitStopTime":"${v}","PitLaneTime":"${k}","Lap":"${k % 60}"}}'
_all(
    "kf_pit_stop_series",
    kf.pit_stop_series,
    template('"${car}":[' + STOP + ',{"PitStop":{"Lap":2}}]'),
    '{"PitTimes":{',
    "}}",
    """SELECT session_id, car AS car_number, 0 AS stop, ts AS utc, car AS racing_number, v AS pit_stop_time, k::DOUBLE AS pit_lane_time,
         k % 60 AS lap FROM st UNION ALL SELECT session_id, car, 1, NULL, NULL, NULL, NULL, 2 FROM st""",
)

# Weather and state

_one("kf_weather", kf.weather, template(READING), f"SELECT session_id, {READING_SQL} FROM last")
_all(
    "kf_weather_series",
    kf.weather_series,
    template('{"Timestamp":"${utc6}7Z","Weather":' + READING + "}"),
    '{"Series":[',
    "]}",
    f"""SELECT session_id, ts AS "timestamp", {READING_SQL} FROM st""",
)
_one(
    "kf_session_info",
    kf.session_info,
    f"concat('[', {template(INFO)}, ']')",
    """SELECT session_id, 9000 + k AS session_key, 'Race' AS session_type, NULL::SMALLINT AS session_number, 'Race' AS session_name,
         ts AS start_date, ts AS end_date, -((k % 9) * 3600 + 1800) AS gmt_offset_s, '2024/m' || k || '/s' || k || '/' AS path,
         1000 + k AS meeting_key, 'Meeting ' || k AS meeting_name, 'Official ' || k AS meeting_official_name, 'L ' || (k % 7) AS meeting_location,
         k % 30 AS country_key, 'C' || (k % 30) AS country_code, 'Country ' || (k % 30) AS country_name, k % 40 AS circuit_key,
         'S' || (k % 40) AS circuit_short_name, 'Complete' AS archive_status FROM last""",
)
MARK = template('{"Utc":"${utc6}Z","Lap":${k % 60},"TrackStatus":"${if(k % 2 = 0, et, \'\')}","SessionStatus":"S${k}"}')
_all(
    "kf_session_laps",
    kf.session_laps,
    MARK,
    '{"Series":[',
    "]}",
    "SELECT session_id, ts AS utc, k % 60 AS lap FROM st",
)
_all(
    "kf_session_statuses",
    kf.session_statuses,
    MARK,
    '{"Series":[],"StatusSeries":[',
    "]}",
    """SELECT session_id, ts AS utc, CASE WHEN k % 2 = 0 THEN et ELSE '' END AS track_status, 'S' || k AS session_status FROM st""",
)
_one(
    "kf_track_status",
    kf.track_status,
    template('{"Status":"${k}","Message":"${et}"}'),
    "SELECT session_id, k AS status, et AS message FROM last",
)
_one(
    "kf_session_status",
    kf.session_status,
    template('{"Status":"${et}"}'),
    "SELECT session_id, et AS status, NULL::VARCHAR AS started FROM last",
)
_one("kf_archive_status", kf.archive_status, template('{"Status":"${et}"}'), "SELECT session_id, et AS status FROM last")
_one(
    "kf_lap_count",
    kf.lap_count,
    template('{"CurrentLap":${k % 60},"TotalLaps":60}'),
    "SELECT session_id, k % 60 AS current_lap, 60 AS total_laps FROM last",
)
_one("kf_heartbeat", kf.heartbeat, template('{"Utc":"${utc6}7Z"}'), "SELECT session_id, ts AS utc FROM last")
_one(
    "kf_clock",
    kf.extrapolated_clock,
    template('{"Utc":"${utc6}7Z","Remaining":"00:${lpad(k % 60, 2, \'0\')}:01","Extrapolating":${k % 2 = 0}}'),
    """SELECT session_id, ts AS utc, ((k % 60) * 60000 + 1000)::BIGINT AS remaining_ms, k % 2 = 0 AS extrapolating FROM last""",
)
_one(
    "kf_tla_rcm",
    kf.tla_rcm,
    template('{"Timestamp":"${utc6}","Message":"M ${k}"}'),
    """SELECT session_id, ts AS "timestamp", 'M ' || k AS message FROM last""",
)
_all(
    "kf_content_streams",
    kf.content_streams,
    template('{"Type":"${et}","Name":"N ${k}","Language":"en","Uri":"u://${k}","Path":"p${car}"}'),
    '{"Streams":[',
    "]}",
    """SELECT session_id, et AS type, 'N ' || k AS name, 'en' AS language, 'u://' || k AS uri, 'p' || car AS path, NULL::VARCHAR AS utc FROM st""",
)

# Validation report


def _report_sql(rows: str, rules: dict[str, str]) -> str:
    arms = ", ".join(f"count(*) FILTER ({broken}) AS {name}" for name, broken in rules.items())
    names = ", ".join(rules)
    return f"""SELECT session_id, rule, "rows", breaches FROM (SELECT session_id, count(*) AS "rows", {arms} FROM ({rows}) GROUP BY session_id)
               UNPIVOT (breaches FOR rule IN ({names}))"""


_all(
    "quality_race_control",
    quality.race_control_report,
    template(MESSAGE),
    '{"Messages":[',
    "]}",
    _report_sql(
        "SELECT * FROM st",
        {
            "category": "et = 'error'",
            "message": "false",
            "utc": "false",
            "lap": "false",
            "flag": "et = 'view' AND k % 10 = 0",
            "scope": "false",
            "sector": "false",
            "safety_car_status": "et = 'click' AND k % 3 <> 0",
            "safety_car_mode": "false",
            "drs_status": "et = 'purchase' AND k % 3 = 0",
        },
    ),
)
_cars(
    "quality_tyres",
    quality.tyre_report,
    TYRES,
    '{"Tyres":{',
    "}}",
    _report_sql("SELECT * FROM st", {"compound": "k % 7 = 6", "new": "k % 10 = 0"}),
)
_cars(
    "quality_lap_times",
    quality.lap_time_report,
    LINE,
    TIMING_BEFORE,
    TIMING_AFTER,
    _report_sql("SELECT * FROM st", {"best_lap_time": "et = 'signup'", "last_lap_time": "false"}),
)
