"""One query per stream feed: lines from events, decoded and flattened, beside SQL straight from the events."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.operators import catalog, feeds, quality
from slipstream.plans.lines import EVENTS_SQL, compressed_lines, entries, stream_lines, template
from slipstream.sources import archive

LAP_TEXT = template("1:${lpad(k % 60, 2, '0')}.${lpad((k * 37) % 1000, 3, '0')}")
LAP_MS = "CAST(60000 + (k % 60) * 1000 + (k * 37) % 1000 AS BIGINT)"
UTC7 = "concat(utc6, '7Z')"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def _table(df: DataFrame) -> DataFrame:
    """Result columns: the feed's own, with the session and line they come from."""
    return df.drop("block_no", "entry_no", "key_pos")


def _feed(flatten: Callable[..., DataFrame], payload: str, sql: str, clock: str = "clock", **options: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _table(flatten(entries(spark, sf_dir, payload, clock, judge=False), **options))

    return Query(run, f"WITH {EVENTS_SQL} {sql}")


def _case(by: str, arms: dict[str, str], other: str) -> str:
    return f"CASE {by} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in arms.items()) + f" ELSE {other} END"


QUERIES: dict[str, Query] = {}

# Scans

RAW_PAYLOAD = template('{"Utc":"${utc6}Z","Value":${k}}')
RAW_SQL = """SELECT session_id, line_no, {entry_no} AS entry_no, timestamp_ms,
  '{{"Utc":"' || utc6 || 'Z","Value":' || {k} || '}}' AS payload FROM e"""


def _raw_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stream_lines(spark, sf_dir, f"concat({RAW_PAYLOAD}, chr(13))")
    blanks = lines.withColumn("value", F.lit("\r"))
    return archive.decode_lines(lines.unionByName(blanks)).drop("block_no")


def _raw_entries_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = RAW_PAYLOAD, template('{"Utc":"${utc6}Z","Value":${k + 1}}')
    key = "CASE WHEN line_no % 2 = 0 THEN 'Entries' ELSE 'Position' END"
    document = f"""concat('{{"', {key}, '":[', {first}, ',', {second}, ']}}')"""
    return archive.decode_lines(compressed_lines(spark, sf_dir, document), compressed=True).drop("block_no")


QUERIES["raw_entries"] = Query(_raw_entries, f"WITH {EVENTS_SQL} " + RAW_SQL.format(entry_no=0, k="k"))
QUERIES["raw_entries_z"] = Query(
    _raw_entries_z,
    f"WITH {EVENTS_SQL} "
    + RAW_SQL.format(entry_no=0, k="k")
    + " UNION ALL "
    + RAW_SQL.format(entry_no=1, k="(k + 1)"),
)


def _bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = "CASE et WHEN 'error' THEN ' no payload here' WHEN 'signup' THEN '{\"no\":\"clock\"}' ELSE '{}' END"
    clock = "CASE et WHEN 'signup' THEN '' ELSE clock END"
    return archive.bad_lines(stream_lines(spark, sf_dir, value, clock)).drop("block_no")


QUERIES["bad_lines"] = Query(
    _bad_lines,
    f"""WITH {EVENTS_SQL} SELECT session_id, line_no, CASE et WHEN 'signup' THEN '{{"no":"clock"}}'
    ELSE strftime(ts, '%H:%M:%S.%g') || ' no payload here' END AS value FROM e WHERE et IN ('error', 'signup')""",
)

# Payloads, documents and blobs that are cut off for some events.


def _cut_off(text: str) -> str:
    return f"CASE WHEN k % 7 = 3 THEN left({text}, length({text}) - 1) ELSE {text} END"


def _bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.line_faults(stream_lines(spark, sf_dir, _cut_off(RAW_PAYLOAD))).select("session_id", "line_no", "fault")


def _bad_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = compressed_lines(spark, sf_dir, f"concat('{{\"Entries\":[', {RAW_PAYLOAD}, ']}}')")
    lines = lines.withColumn("value", F.when(F.col("line_no") % 7 == 3, F.concat(F.substring("value", 1, 33), F.lit('"'))).otherwise(F.col("value")))
    return archive.line_faults(lines, compressed=True).select("session_id", "line_no", "fault")


def _bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stream_lines(spark, sf_dir, _cut_off(RAW_PAYLOAD), "''").select(F.concat_ws("/", "session_id", "line_no").alias("session_id"), F.col("value").alias("doc"))
    return archive.document_faults(docs)


def _drop_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.decode_lines(stream_lines(spark, sf_dir, _cut_off(RAW_PAYLOAD)), on_bad="drop").drop("block_no")


def _quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_report(stream_lines(spark, sf_dir, _cut_off(RAW_PAYLOAD)))


QUERIES["bad_payloads"] = Query(_bad_payloads, f"WITH {EVENTS_SQL} SELECT session_id, line_no, 'json' AS fault FROM e WHERE k % 7 = 3")
QUERIES["bad_blobs"] = Query(_bad_blobs, f"WITH {EVENTS_SQL} SELECT session_id, line_no, 'blob' AS fault FROM e WHERE line_no % 7 = 3")
QUERIES["bad_documents"] = Query(_bad_documents, f"WITH {EVENTS_SQL} SELECT session_id || '/' || line_no AS session_id, 'json' AS fault FROM e WHERE k % 7 = 3")
QUERIES["sound_entries"] = Query(_drop_broken, f"WITH {EVENTS_SQL} " + RAW_SQL.format(entry_no=0, k="k") + " WHERE k % 7 <> 3")
QUERIES["quality_lines"] = Query(
    _quality_lines,
    f"""WITH {EVENTS_SQL} SELECT session_id, rule, "rows", breaches FROM (
      SELECT session_id, count(*) AS "rows", 0::BIGINT AS mark, 0::BIGINT AS clock, 0::BIGINT AS blob, count(*) FILTER (k % 7 = 3) AS json
      FROM e GROUP BY session_id) UNPIVOT (breaches FOR rule IN (mark, clock, blob, json))""",
)

# Telemetry

# A share of the lines has odd shapes: numbers as text, a list for channels, cars that are no objects.
CAR_HEAD = '{"Utc":"${utc6}7Z","Cars":{"${car}":{"Channels":{"0":${k * 100},"2":'
CAR_PAYLOAD = f"""CASE WHEN et = 'error' THEN {template(
    CAR_HEAD + '"${k}","3":${k % 9},"4":${v},"5":0,"45":${k % 15}}},'
    '"${car + 20}":{"Channels":[1]},"${car + 40}":{"Channels":{"2":${k}}},"99":null,"98":"x"}}'
)} ELSE {template(
    CAR_HEAD + '${k},"3":${k % 9},"4":${v},"5":0,"45":${k % 15}}},'
    '"${car + 20}":{},"${car + 40}":{"Channels":{"2":${k}}}}}'
)} END"""
CAR_COLUMNS = "session_id, line_no, timestamp_ms, ts AS utc"
CAR_SQL = f"""
  SELECT {CAR_COLUMNS}, car::SMALLINT AS racing_number, k * 100 AS rpm, k AS speed, (k % 9)::SMALLINT AS gear,
         v AS throttle, 0::SMALLINT AS brake, (k % 15)::SMALLINT AS drs FROM e
  UNION ALL SELECT {CAR_COLUMNS}, (car + 20)::SMALLINT, 0, 0, 0::SMALLINT, 0::DOUBLE, 0::SMALLINT, NULL FROM e
  UNION ALL SELECT {CAR_COLUMNS}, (car + 40)::SMALLINT, 0, k, 0::SMALLINT, 0::DOUBLE, 0::SMALLINT, NULL FROM e"""
QUERIES["car_data"] = _feed(feeds.car_data, CAR_PAYLOAD, CAR_SQL)


def _car_data_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = f"""concat('{{"Entries":[', {CAR_PAYLOAD}, ']}}')"""
    lines = compressed_lines(spark, sf_dir, document)
    return _table(feeds.car_data_docs(archive.inflate_lines(lines, judge=False)))


QUERIES["car_data_z"] = Query(_car_data_z, f"WITH {EVENTS_SQL} {CAR_SQL}")

POSITION_PAYLOAD = template(
    '{"Timestamp":"${utc6}Z","Entries":{"${car}":{"Status":"OnTrack","X":${k * 10},"Y":${v},"Z":${-k}},'
    '"${car + 20}":{"Status":"OffTrack","X":0},"99":null}}'
)
QUERIES["position"] = _feed(
    feeds.position,
    POSITION_PAYLOAD,
    """SELECT session_id, line_no, timestamp_ms, utc6 || 'Z' AS utc, car::SMALLINT AS racing_number,
       'OnTrack' AS status, (k * 10)::DOUBLE AS x, v AS y, (-k)::DOUBLE AS z FROM e
       UNION ALL SELECT session_id, line_no, timestamp_ms, utc6 || 'Z', (car + 20)::SMALLINT, 'OffTrack', 0::DOUBLE,
       NULL, NULL FROM e""",
)

# Timing

# Snapshots (here: errors) hold lists and odd children; deltas are objects with a segment's number as key.
SEGMENTS = (
    "concat('{\"Segments\":', if(et = 'error', '[', '{'), array_join(transform(sequence(0, k % 4), i -> "
    "concat(if(et = 'error', '', concat('\"', i, '\":')), '{\"Status\":', CAST(2048 + i AS STRING), '}')), ','), if(et = 'error', ']', '}'), '}')"
)
OBJECT_SEGMENTS = f"""CASE WHEN et = 'error' THEN {template('{"Segments":{"5":{"Status":${k}},"6":{"Other":1},"7":null,"8":{"Status":null}}}')}
    ELSE {template('{"Segments":{"5":{"Status":${k}},"6":{"Other":1}}}')} END"""
QUERIES["timing_segments"] = _feed(
    feeds.timing_segments,
    f"""concat('{{"Lines":{{"', CAST(car AS STRING), '":{{"Sectors":', CASE WHEN et = 'error'
        THEN concat('[', {SEGMENTS}, ',', {OBJECT_SEGMENTS}, ']')
        ELSE concat('{{"0":', {SEGMENTS}, ',"2":', {OBJECT_SEGMENTS}, ',"1":null}}') END,
        '}},"77":{{"Sectors":null}}', if(et = 'error', ',"78":[]', ''), '}}}}')""",
    """SELECT session_id, line_no, timestamp_ms, car::VARCHAR AS car_number, 1::SMALLINT AS sector, i::SMALLINT AS segment,
         (2048 + i)::INTEGER AS status FROM (SELECT *, unnest(range(k % 4 + 1)) AS i FROM e)
       UNION ALL SELECT session_id, line_no, timestamp_ms, car::VARCHAR,
         (CASE WHEN et = 'error' THEN 2 ELSE 3 END)::SMALLINT, 5::SMALLINT, k FROM e""",
)

STATS = _case(
    "et",
    {
        "view": template('"BestSpeeds":{"I1":{"Value":"${k}","Position":${k % 20}},"ST":{"Value":""},"FL":null}'),
        "click": template('"BestSectors":[{"Value":"${v}","Position":${k % 20}},{"Value":""},null]'),
        "purchase": template('"BestSectors":{"2":{"Value":${v},"Position":"${k % 20}"}},"BestSpeeds":[1]'),
    },
    f"""concat('"PersonalBestLapTime":{{"Value":"', {LAP_TEXT}, '","Lap":', CAST(k AS STRING), '}}')""",
)
STATS_HEAD = "SELECT session_id, line_no, timestamp_ms, car::VARCHAR AS car_number"
QUERIES["timing_stats"] = _feed(
    feeds.timing_stats,
    f"""concat('{{"Lines":{{"', CAST(car AS STRING), '":{{', {STATS}, '}}}}}}')""",
    f"""{STATS_HEAD}, 'speed' AS stat_type, (k % 20)::SMALLINT AS position, 'I1' AS trap, k AS speed,
         NULL::SMALLINT AS sector, NULL::DOUBLE AS time_seconds, NULL::BIGINT AS lap_time_ms, NULL::INTEGER AS lap
       FROM e WHERE et = 'view'
       UNION ALL {STATS_HEAD}, 'speed', NULL, 'ST', NULL, NULL, NULL, NULL, NULL FROM e WHERE et = 'view'
       UNION ALL {STATS_HEAD}, 'sector', (k % 20)::SMALLINT, NULL, NULL, 0::SMALLINT, v, NULL, NULL FROM e WHERE et = 'click'
       UNION ALL {STATS_HEAD}, 'sector', NULL, NULL, NULL, 1::SMALLINT, NULL, NULL, NULL FROM e WHERE et = 'click'
       UNION ALL {STATS_HEAD}, 'sector', (k % 20)::SMALLINT, NULL, NULL, 2::SMALLINT, v, NULL, NULL FROM e WHERE et = 'purchase'
       UNION ALL {STATS_HEAD}, 'personal_best', NULL, NULL, NULL, NULL, NULL, {LAP_MS}, k FROM e
         WHERE et NOT IN ('view', 'click', 'purchase')""",
)

COMPOUND = "element_at(array('HARD','MEDIUM','SOFT','INTERMEDIATE','WET','UNKNOWN','HYPERSOFT'), k % 7 + 1)"
COMPOUND_SQL = "(['HARD','MEDIUM','SOFT','INTERMEDIATE','WET','UNKNOWN','HYPERSOFT'])[k % 7 + 1]"
FULL_STINT = template(
    '{"Compound":"${' + COMPOUND + '}","New":"${if(k % 2 = 0, \'true\', \'false\')}","TyresNotChanged":"0",'
    '"TotalLaps":${k},"StartLaps":"${k % 5}","LapTime":"${' + LAP_TEXT + '}","LapNumber":${k % 70},"LapFlags":1}'
)
DELTA_STINT = template('{"TotalLaps":${k + 1},"New":true}')
STINTS = f"""CASE WHEN line_no % 2 = 0 THEN concat('[', {FULL_STINT}, ',null]')
             ELSE concat('{{"1":', {DELTA_STINT}, ',"2":[]}}') END"""
LAP_TEXT_SQL = "'1:' || lpad((k % 60)::VARCHAR, 2, '0') || '.' || lpad(((k * 37) % 1000)::VARCHAR, 3, '0')"
QUERIES["stints_app"] = _feed(
    feeds.timing_app,
    f"""concat('{{"Lines":{{"', CAST(car AS STRING), '":{{"Stints":', {STINTS}, '}},"88":{{"Line":1}}}}}}')""",
    f"""SELECT session_id, line_no, timestamp_ms, car::VARCHAR AS car_number, 0::SMALLINT AS stint_number,
         {COMPOUND_SQL} AS compound, k % 2 = 0 AS "new", 0::SMALLINT AS tyres_not_changed, k AS total_laps,
         k % 5 AS start_laps, {LAP_TEXT_SQL} AS lap_time, k % 70 AS lap_number, 1::SMALLINT AS lap_flags
       FROM e WHERE line_no % 2 = 0
       UNION ALL SELECT session_id, line_no, timestamp_ms, car::VARCHAR, 1::SMALLINT, NULL, NULL, NULL, k + 1, NULL,
         NULL, NULL, NULL FROM e WHERE line_no % 2 = 1""",
)
STINT_PAYLOAD = f"""concat('{{"Stints":{{"', CAST(car AS STRING), '":', {STINTS}, ',"88":null}}}}')"""
STINT_SQL = f"""SELECT session_id, line_no, timestamp_ms, car::SMALLINT AS car_number, 1::SMALLINT AS stint_index,
         NULL::VARCHAR AS compound, NULL::BOOLEAN AS "new", NULL::SMALLINT AS tyres_not_changed, k + 1 AS total_laps,
         NULL::INTEGER AS start_laps FROM e WHERE line_no % 2 = 1"""
QUERIES["stint_series"] = _feed(
    feeds.tyre_stints,
    STINT_PAYLOAD,
    f"""{STINT_SQL} UNION ALL SELECT session_id, line_no, timestamp_ms, car::SMALLINT, 0::SMALLINT, {COMPOUND_SQL},
         k % 2 = 0, 0::SMALLINT, k, k % 5 FROM e WHERE line_no % 2 = 0""",
)
QUERIES["stint_series_compat"] = _feed(feeds.tyre_stints, STINT_PAYLOAD, STINT_SQL, compat=True)

QUERIES["current_tyres"] = _feed(
    feeds.current_tyres,
    template(
        '{"Tyres":{"${car}":{"Compound":"${' + COMPOUND + '}","New":${k % 2 = 0}},"${car + 20}":{"Age":1},"77":null}}'
    ),
    f"""SELECT session_id, line_no, timestamp_ms, car::SMALLINT AS racing_number,
         CASE WHEN k % 7 < 6 THEN {COMPOUND_SQL} ELSE 'UNKNOWN' END AS compound, k % 2 = 0 AS "new" FROM e
       UNION ALL SELECT session_id, line_no, timestamp_ms, (car + 20)::SMALLINT, 'UNKNOWN', false FROM e""",
)

LAP_POSITIONS = f"""CASE WHEN line_no % 2 = 0 THEN {template('[${k % 20},"${(k + 1) % 20}"]')}
                    ELSE {template('{"${k}":${k % 20},"${k + 1}":"${(k + 1) % 20}"}')} END"""
LAP_SERIES_PAYLOAD = (
    f"""concat('{{"', CAST(car AS STRING), '":{{"LapPosition":', {LAP_POSITIONS}, '}},"66":{{"Other":1}},"67":null}}')"""
)


def _lap_series_sql(which: str, offset: int, lap: str) -> str:
    return f"""SELECT session_id, line_no, timestamp_ms, car::SMALLINT AS racing_number, ({lap})::SMALLINT AS lap,
               ((k + {offset}) % 20)::SMALLINT AS position FROM e WHERE line_no % 2 = {which}"""


LAP_SERIES_OBJECTS = _lap_series_sql("1", 0, "k") + " UNION ALL " + _lap_series_sql("1", 1, "k + 1")
QUERIES["lap_series"] = _feed(
    feeds.lap_series,
    LAP_SERIES_PAYLOAD,
    LAP_SERIES_OBJECTS + " UNION ALL " + _lap_series_sql("0", 0, "0") + " UNION ALL " + _lap_series_sql("0", 1, "1"),
)
QUERIES["lap_series_compat"] = _feed(feeds.lap_series, LAP_SERIES_PAYLOAD, LAP_SERIES_OBJECTS, compat=True)

LAP_COUNT_PAYLOAD = _case(
    "et",
    {
        "view": template('{"CurrentLap":${k % 60 + 1},"TotalLaps":${60 + k % 3}}'),
        "error": template('{"TotalLaps":"${k}"}'),
        "purchase": template('{"TotalLaps":${70 + k % 3}}'),
    },
    template('{"CurrentLap":${k % 60 + 1}}'),
)
LAP_COUNT_SQL = """SELECT session_id, line_no, timestamp_ms,
  (CASE WHEN et IN ('error', 'purchase') THEN NULL ELSE k % 60 + 1 END)::SMALLINT AS lap,
  CASE et WHEN 'view' THEN 60 + k % 3 WHEN 'purchase' THEN 70 + k % 3 END AS total_laps FROM e"""
QUERIES["lap_count"] = _feed(feeds.lap_count, LAP_COUNT_PAYLOAD, LAP_COUNT_SQL)
QUERIES["lap_totals"] = _feed(
    lambda raw: catalog.lap_totals(feeds.lap_count(raw)),
    LAP_COUNT_PAYLOAD,
    f"""SELECT session_id, coalesce(arg_max(total_laps, line_no) FILTER (total_laps IS NOT NULL), 0)::INTEGER AS total_laps,
        coalesce(max(lap), 0)::INTEGER AS current_lap FROM ({LAP_COUNT_SQL}) GROUP BY session_id""",
)

TRACKER_FIELDS = (
    '"LapState":${k * 3},"LapTime":"${if(et = \'error\', \'\', ' + LAP_TEXT + ')}",'
    '"DiffToAhead":"${if(line_no % 2 = 0, concat(\'+\', v), concat(k, \'L\'))}",'
    '"DiffToLeader":${if(et = \'view\', \'"xL"\', if(et = \'click\', \'12.5\', concat(\'"\', v, \'"\')))}'
)
TRACKER_SQL = f"""(k * 3)::SMALLINT AS lap_state, CASE WHEN et <> 'error' THEN {LAP_MS} END AS lap_time_ms,
  CASE WHEN line_no % 2 = 0 THEN v ELSE (-k)::DOUBLE END AS diff_to_ahead,
  CASE WHEN et NOT IN ('view', 'click') THEN v END AS diff_to_leader"""
QUERIES["driver_tracker"] = _feed(
    feeds.driver_tracker,
    template('{"Lines":{"${car}":{' + TRACKER_FIELDS + '},"77":null}}'),
    f"SELECT session_id, line_no, timestamp_ms, car::SMALLINT AS racing_number, {TRACKER_SQL} FROM e",
)
LEADER = '{"RacingNumber":"${car}","Tla":"T${car}","BroadcastName":"B ${car}","FullName":"F ${car}","Team":"Team ${car % 10}","TeamColour":"00${car}",' + TRACKER_FIELDS + "}"
TOP_PAYLOAD = f"""CASE WHEN line_no % 2 = 0 THEN {template('{"Lines":[null,' + LEADER + ']}')}
                  ELSE {template('{"Lines":{"2":' + LEADER + '}}')} END"""
TOP_SQL = f"""SELECT session_id, line_no, timestamp_ms, (CASE WHEN line_no % 2 = 0 THEN 2 ELSE 3 END)::SMALLINT AS position,
  car::SMALLINT AS racing_number, 'T' || car AS tla, 'B ' || car AS broadcast_name, 'F ' || car AS full_name,
  'Team ' || (car % 10) AS team, '00' || car AS team_colour, {TRACKER_SQL} FROM e"""
QUERIES["top_three"] = _feed(feeds.top_three, TOP_PAYLOAD, TOP_SQL)
QUERIES["top_three_compat"] = _feed(feeds.top_three, TOP_PAYLOAD, TOP_SQL + " WHERE line_no % 2 = 1", compat=True)

# Pit lane

QUERIES["pit_stop_fill"] = _feed(
    feeds.pit_stop,
    f"""concat({template('{"RacingNumber":"${car}","PitStopTime":"${v}","PitLaneTime":${k}.5')},
        CASE et WHEN 'purchase' THEN {template(',"Lap":"${k}"')} ELSE '' END, '}}')""",
    """SELECT session_id, line_no, timestamp_ms, car::SMALLINT AS racing_number, v AS pit_stop_time, k + 0.5::DOUBLE AS pit_lane_time,
         last_value((CASE WHEN et = 'purchase' THEN k END)::SMALLINT IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY line_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lap FROM e""",
)
STOP = '{"Timestamp":"${utc6}7Z","PitStop":{"RacingNumber":"${car}","PitStopTime":"${v}","PitLaneTime":"${k}","Lap":"${k % 60}"}}'
STOPS_SQL = """SELECT session_id, line_no, timestamp_ms, ts AS utc, car::SMALLINT AS racing_number, v AS pit_stop_time,
         k::DOUBLE AS pit_lane_time, (k % 60)::SMALLINT AS lap FROM e"""
LATE_STOP = '{"Timestamp":"2020-01-01T00:00:00Z","PitStop":{"Lap":"1"}}'
STOPS_PAYLOAD = f"""CASE WHEN line_no % 2 = 0 THEN {template('{"PitTimes":{"${car}":[' + STOP + ',' + LATE_STOP + '],"55":[],"56":null}}')}
        ELSE {template('{"PitTimes":{"${car}":{"4":' + STOP + ',"3":' + LATE_STOP + '},"57":{"0":null}}}')} END"""
QUERIES["pit_stop_series"] = _feed(
    feeds.pit_stop_series,
    STOPS_PAYLOAD,
    STOPS_SQL
    + """ UNION ALL SELECT session_id, line_no, timestamp_ms, TIMESTAMP '2020-01-01', car::SMALLINT, NULL, NULL, 1::SMALLINT FROM e""",
)
QUERIES["pit_stop_series_compat"] = _feed(feeds.pit_stop_series, STOPS_PAYLOAD, STOPS_SQL, compat=True)

PIT_INSERT = '"${car}":{"RacingNumber":"${car}","Duration":"${v}","Lap":"${k % 60}"}'
PIT_NEXT = '"n":{"RacingNumber":"${car % 20 + 1}","Duration":"${v}","Lap":"${k % 60}"}'
PIT_PAYLOAD = _case(
    "et",
    {
        "purchase": template('{"PitTimes":{' + PIT_INSERT + "}}"),
        "error": template('{"PitTimes":{"_deleted":["${car}","${car % 20 + 1}"]}}'),
        "click": template('{"PitTimes":{"${car}":{"RacingNumber":"${car}","_deleted":true}}}'),
        "view": template('{"PitTimes":{' + PIT_INSERT + "," + PIT_NEXT + "}}"),
    },
    template('{"PitTimes":{"_deleted":["${car}"],' + PIT_NEXT + "}}"),
)
PIT_MARKS_SQL = """marks AS (
    SELECT session_id, line_no, 0 AS pos, timestamp_ms, car AS c, et IN ('purchase', 'view') AS ins, v, k, et FROM e
    UNION ALL SELECT session_id, line_no, 1, timestamp_ms, car % 20 + 1, et <> 'error', v, k, et FROM e
      WHERE et IN ('error', 'view', 'signup'))"""
PIT_PATCH_SQL = """, grouped AS (
    SELECT *, count(*) FILTER ({ins}) OVER (PARTITION BY session_id, c ORDER BY line_no, pos) AS g FROM marks)
  SELECT session_id, arg_min(line_no, (line_no, pos)) AS line_no, min(timestamp_ms) AS timestamp_ms, c::SMALLINT AS racing_number,
    (arg_min(v, (line_no, pos)))::DOUBLE AS duration, (arg_min(k % 60, (line_no, pos)))::SMALLINT AS lap,
    (arg_max({{'at': {at}}}, (line_no, pos)) FILTER (NOT ({ins}))).at AS broadcast_deleted_at_ms
  FROM grouped WHERE g > 0 GROUP BY session_id, c, g"""
QUERIES["pit_lane_patch"] = Query(
    lambda spark, sf_dir: _table(feeds.pit_lane_times(entries(spark, sf_dir, PIT_PAYLOAD, judge=False))),
    f"WITH {EVENTS_SQL}, {PIT_MARKS_SQL}" + PIT_PATCH_SQL.format(ins="ins", at="timestamp_ms"),
)
QUERIES["pit_lane_patch_compat"] = Query(
    lambda spark, sf_dir: _table(feeds.pit_lane_times(entries(spark, sf_dir, PIT_PAYLOAD, judge=False), compat=True)),
    f"WITH {EVENTS_SQL}, {PIT_MARKS_SQL}" + PIT_PATCH_SQL.format(
        ins="et IN ('purchase', 'view')", at="CASE WHEN et = 'signup' AND pos = 1 THEN NULL ELSE timestamp_ms END"
    ),
)

# Race control and track state

CATEGORY = _case("et", {"view": "'Flag'", "click": "'SafetyCar'", "purchase": "'Drs'", "signup": "'Other'"}, "'Strange'")
MESSAGE = (
    '{"Utc":"${utc6}Z","Category":"${' + CATEGORY + '}","Message":"M ${k}","Lap":${k},"Flag":"${if(k % 10 = 0, \'PINK\', \'RED\')}",'
    '"Scope":"Track","Sector":${k % 20},"RacingNumber":"${car}","Status":"${if(k % 3 = 0, \'DEPLOYED\', \'ENABLED\')}",'
    '"Mode":"${if(k % 2 = 0, \' vsc \', \'Safety Car\')}"}'
)
RCM_PAYLOAD = f"""CASE WHEN line_no % 2 = 0 THEN {template('{"Messages":[' + MESSAGE + ',null]}')}
                  ELSE {template('{"Messages":{"${k}":' + MESSAGE + ',"x":"y"}}')} END"""
RCM_SQL = f"""SELECT session_id, line_no, timestamp_ms, utc6 || 'Z' AS utc, {CATEGORY} AS category, 'M ' || k AS message,
    k::SMALLINT AS lap, CASE WHEN k % 10 = 0 THEN 'PINK' ELSE 'RED' END AS flag, 'Track' AS scope, (k % 20)::SMALLINT AS sector,
    car::VARCHAR AS racing_number, CASE WHEN k % 3 = 0 THEN 'DEPLOYED' ELSE 'ENABLED' END AS status,
    CASE WHEN k % 2 = 0 THEN ' vsc ' ELSE 'Safety Car' END AS mode FROM e"""
QUERIES["rcm"] = _feed(feeds.race_control, RCM_PAYLOAD, RCM_SQL)


def _rcm_per_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = entries(spark, sf_dir, f"CASE WHEN et = 'error' THEN '{{}}' ELSE {RCM_PAYLOAD} END")
    sessions = raw.select(F.substring("session_id", 1, 4).cast("int").alias("year"), "session_id").distinct()
    return catalog.messages_per_session(feeds.race_control(raw), sessions)


QUERIES["rcm_per_session"] = Query(
    _rcm_per_session,
    f"""WITH {EVENTS_SQL}, n AS (SELECT session_id, count(*) FILTER (et <> 'error') AS messages FROM e GROUP BY session_id)
        SELECT substr(session_id, 1, 4)::INTEGER AS "year", session_id, messages,
          round(avg(messages) OVER (PARTITION BY substr(session_id, 1, 4)), 6) AS season_mean FROM n""",
)
QUERIES["tla_rcm"] = _feed(
    feeds.tla_rcm,
    template('{"Timestamp":"${utc6}","Message":"M ${k}"}'),
    "SELECT session_id, line_no, timestamp_ms, ts AS utc, 'M ' || k AS message FROM e",
)
QUERIES["track_status"] = _feed(
    feeds.track_status,
    template('{"Status":"${k}","Message":"${et}"}'),
    "SELECT session_id, line_no, timestamp_ms, k::SMALLINT AS status, et AS message FROM e",
)
QUERIES["session_status"] = _feed(
    feeds.session_status,
    f"""CASE WHEN k % 2 = 0 THEN {template('{"Status":"${et}","Started":"${k}"}')} ELSE {template('{"Status":"${et}"}')} END""",
    "SELECT session_id, line_no, timestamp_ms, et AS status, CASE WHEN k % 2 = 0 THEN k::VARCHAR END AS started FROM e",
)
QUERIES["archive_status"] = _feed(
    feeds.archive_status,
    template('{"Status":"${et}"}'),
    "SELECT session_id, line_no, timestamp_ms, et AS status FROM e",
)

# Weather

READING = (
    '{"AirTemp":"${v}","Humidity":"${k}.0","Pressure":"10${k % 10}.5","Rainfall":"${k % 2}",'
    '"TrackTemp":${k}.25,"WindDirection":"${k * 3}","WindSpeed":""}'
)
READING_SQL = """v AS air_temp, k::DOUBLE AS humidity, 100.5::DOUBLE + k % 10 AS pressure, (k % 2)::DOUBLE AS rainfall,
  k + 0.25::DOUBLE AS track_temp, k * 3 AS wind_direction, NULL::DOUBLE AS wind_speed"""
QUERIES["weather"] = _feed(
    feeds.weather, template(READING), f"SELECT session_id, line_no, timestamp_ms, {READING_SQL} FROM e"
)
TIMED = '{"Timestamp":"${utc6}7Z","Weather":' + READING + "}"
BARE = '{"Timestamp":null,"Weather":{}}'
SERIES_PAYLOAD = f"""CASE k % 3 WHEN 0 THEN {template('{"Series":[' + TIMED + "," + BARE + "]}")}
  WHEN 1 THEN {template('{"Series":{"7":' + TIMED + ',"8":null}}')}
  ELSE {template('{"Series":{"7":[' + TIMED + "," + BARE + "]}}")} END"""
SERIES_SQL = f"SELECT session_id, line_no, timestamp_ms, ts AS utc, {READING_SQL} FROM e"
QUERIES["weather_series"] = _feed(
    feeds.weather_series,
    SERIES_PAYLOAD,
    SERIES_SQL
    + """ UNION ALL SELECT session_id, line_no, timestamp_ms, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM e WHERE k % 3 <> 1""",
)
QUERIES["weather_series_compat"] = _feed(feeds.weather_series, SERIES_PAYLOAD, SERIES_SQL, compat=True)

# Drivers and standings

QUERIES["driver_list"] = _feed(
    feeds.driver_list,
    template('{"${car}":{"Line":${k},"Tla":"x"},"${car + 20}":{"Tla":"y"},"${car + 40}":{"Line":null},"z":1}'),
    """SELECT session_id, line_no, timestamp_ms, car::VARCHAR AS car_number, k::SMALLINT AS line FROM e
       UNION ALL SELECT session_id, line_no, timestamp_ms, (car + 40)::VARCHAR, NULL FROM e""",
)

MILLI = "lpad(CAST((k * 37) % 1000 AS STRING), 3, '0')"
MILLI_SQL = "lpad(((k * 37) % 1000)::VARCHAR, 3, '0')"
GAP = _case(
    "et",
    {
        "view": "concat('LAP ', k)",
        "click": "concat('+', k, ' LAP')",
        "purchase": f"concat('+', k % 3, ':', k % 60, '.', {MILLI})",
        "signup": f"concat('+', k, '.', {MILLI})",
    },
    "''",
)
RACE_PAYLOAD = template(
    '{"${car}":{"Position":"${k % 20 + 1}","Gap":"${' + GAP + '}","Interval":"${' + GAP + '}","Catching":${k % 4},'
    '"OvertakeState":${k % 4},"PitStops":${k % 5},"IsOut":${k % 2 = 0}},'
    '"${car + 20}":{"Position":${k % 20 + 1},"Catching":"1"},"${car + 40}":{"Gap":1.5},"q":null}'
)
RACE_CLOCK = "concat(substring(clock, 1, 3), '00:00.000')"
SECONDS_SQL = f"""CASE et WHEN 'purchase' THEN (k % 3) * 60.0::DOUBLE + ((k % 60) || '.' || {MILLI_SQL})::DOUBLE
  WHEN 'signup' THEN 0 * 60.0::DOUBLE + (k || '.' || {MILLI_SQL})::DOUBLE END"""
RACE_ROWS_SQL = f"""r AS (
  SELECT session_id, line_no, timestamp_ms - timestamp_ms % 3600000 AS timestamp_ms, car::VARCHAR AS car_number,
    (k % 20 + 1)::SMALLINT AS position, {SECONDS_SQL} AS gap_seconds,
    (CASE et WHEN 'click' THEN k ELSE 0 END)::SMALLINT AS laps_behind, {SECONDS_SQL} AS interval_seconds,
    CASE k % 4 WHEN 1 THEN 'not_closing' WHEN 2 THEN 'closing' END AS catching,
    CASE k % 4 WHEN 0 THEN 'lost_position' WHEN 1 THEN 'neutral' WHEN 2 THEN 'gained_position' END AS overtake_state,
    et = 'view' AS is_leader, CASE et WHEN 'view' THEN k END AS leader_lap, (k % 5)::SMALLINT AS pit_stops, k % 2 = 0 AS is_out FROM e
  UNION ALL SELECT session_id, line_no, timestamp_ms - timestamp_ms % 3600000, (car + 20)::VARCHAR, (k % 20 + 1)::SMALLINT,
    NULL, 0::SMALLINT, NULL, NULL, NULL, false, NULL, NULL, NULL FROM e
  UNION ALL SELECT session_id, line_no, timestamp_ms - timestamp_ms % 3600000, (car + 40)::VARCHAR, NULL,
    NULL, 0::SMALLINT, NULL, NULL, NULL, false, NULL, NULL, NULL FROM e),
f AS (SELECT session_id, min(line_no) AS first_line FROM e GROUP BY session_id)"""
QUERIES["race_info_last"] = Query(
    lambda spark, sf_dir: _table(feeds.driver_race_info(entries(spark, sf_dir, RACE_PAYLOAD, RACE_CLOCK, judge=False))),
    f"""WITH {EVENTS_SQL}, {RACE_ROWS_SQL} SELECT r.* FROM r JOIN f USING (session_id) WHERE line_no > first_line
        QUALIFY row_number() OVER (PARTITION BY session_id, timestamp_ms, car_number ORDER BY line_no DESC) = 1""",
)
QUERIES["starting_grid"] = Query(
    lambda spark, sf_dir: _table(feeds.starting_grid(entries(spark, sf_dir, RACE_PAYLOAD, RACE_CLOCK, judge=False))),
    f"""WITH {EVENTS_SQL}, {RACE_ROWS_SQL} SELECT session_id, line_no, timestamp_ms, position, car_number,
          rank() OVER (PARTITION BY session_id ORDER BY position)::INTEGER AS grid_rank
        FROM r JOIN f USING (session_id) WHERE line_no = first_line AND position IS NOT NULL""",
)
QUERIES["championship"] = _feed(
    feeds.championship,
    template(
        '{"Drivers":{"${car}":{"PredictedPosition":${k % 20},"PredictedPoints":${v}},"x":null},'
        '"Teams":{"Team ${car % 10}":{"PredictedPoints":"${k}"}}}'
    ),
    """SELECT session_id, line_no, timestamp_ms, 'driver' AS entry_type, car::VARCHAR AS entry_key,
         (k % 20)::SMALLINT AS predicted_position, v AS predicted_points FROM e
       UNION ALL SELECT session_id, line_no, timestamp_ms, 'team', 'Team ' || (car % 10), NULL, k::DOUBLE FROM e""",
)
OVERTAKES = f"""CASE WHEN line_no % 2 = 0 THEN {template('[{"Timestamp":"${utc6}7Z","count":${k}},{"Count":"1"}]')}
                ELSE {template('{"4":{"Timestamp":"${utc6}7Z","count":${k}},"5":null}')} END"""
QUERIES["overtakes"] = _feed(
    feeds.overtakes,
    f"""concat('{{"Overtakes":{{"', CAST(car AS STRING), '":', {OVERTAKES}, ',"50":null}}}}')""",
    """SELECT session_id, line_no, timestamp_ms, ts_ms AS utc, car::SMALLINT AS racing_number, k::SMALLINT AS count FROM e
       UNION ALL SELECT session_id, line_no, timestamp_ms, NULL, car::SMALLINT, 1::SMALLINT FROM e WHERE line_no % 2 = 0""",
)

# Session state

INFO = (
    '{"Meeting":{"Key":${1000 + k},"Name":"Meeting ${k}","OfficialName":"Official ${k}","Location":"L ${k % 7}","Number":${k % 24},'
    '"Country":{"Key":${k % 30},"Code":"C${k % 30}","Name":"Country ${k % 30}"},"Circuit":{"Key":${k % 40},"ShortName":"S${k % 40}"}},'
    '"ArchiveStatus":{"Status":"Complete"},"SessionStatus":"${et}","Key":${9000 + k},"Type":"Race","Name":"Race",'
    '"StartDate":"${utc6}","EndDate":"${utc6}","GmtOffset":"-0${k % 9}:30:00","Path":"2024/m${k}/s${k}/"}'
)
QUERIES["session_info"] = _feed(
    feeds.session_info,
    f"CASE WHEN et = 'error' THEN '{{\"Meeting\":null,\"Key\":\"7\"}}' ELSE {template(INFO)} END",
    """SELECT session_id, line_no, timestamp_ms, 1000 + k AS meeting_key, 'Meeting ' || k AS meeting_name,
         'Official ' || k AS meeting_official_name, 'L ' || (k % 7) AS meeting_location, (k % 24)::SMALLINT AS meeting_number,
         k % 30 AS country_key, 'C' || (k % 30) AS country_code, 'Country ' || (k % 30) AS country_name, k % 40 AS circuit_key,
         'S' || (k % 40) AS circuit_short_name, et AS session_status, 'Complete' AS archive_status, 9000 + k AS session_key,
         'Race' AS session_type, NULL::SMALLINT AS session_number, 'Race' AS session_name, utc6 AS start_date, utc6 AS end_date,
         '-0' || (k % 9) || ':30:00' AS gmt_offset, '2024/m' || k || '/s' || k || '/' AS path FROM e WHERE et <> 'error'
       UNION ALL SELECT session_id, line_no, timestamp_ms, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         7, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM e WHERE et = 'error'""",
)
DATA_PAYLOAD = _case(
    "et",
    {
        "view": template('{"Series":[{"Utc":"${utc6}Z","Lap":${k % 60}},{"Utc":"${utc6}Z","Lap":${k % 60 + 1}}]}'),
        "click": template(
            '{"Series":{"1":{"Utc":"${utc6}Z","Lap":${k % 60}}},"StatusSeries":{"2":{"Utc":"${utc6}Z","TrackStatus":"Yellow"},'
            '"3":{"Utc":"${utc6}Z","SessionStatus":"Started"}}}'
        ),
        "purchase": "'{}'",
    },
    template('{"StatusSeries":{"${k}":{"Utc":"${utc6}Z","TrackStatus":"${et}"}}}'),
)
DATA_HEAD = "SELECT session_id, line_no, timestamp_ms"
DATA_REST = """ UNION ALL SELECT session_id, line_no, timestamp_ms, 'StatusSeries', ts, NULL, et, NULL FROM e
                WHERE et IN ('error', 'signup')"""
QUERIES["session_data"] = _feed(
    feeds.session_data,
    DATA_PAYLOAD,
    f"""{DATA_HEAD}, 'Series' AS series_type, ts AS utc, (k % 60)::SMALLINT AS lap, NULL::VARCHAR AS track_status,
          NULL::VARCHAR AS session_status FROM e WHERE et IN ('view', 'click')
        UNION ALL {DATA_HEAD}, 'Series', ts, (k % 60 + 1)::SMALLINT, NULL, NULL FROM e WHERE et = 'view'
        UNION ALL {DATA_HEAD}, 'StatusSeries', ts, NULL, 'Yellow', NULL FROM e WHERE et = 'click'
        UNION ALL {DATA_HEAD}, 'StatusSeries', ts, NULL, NULL, 'Started' FROM e WHERE et = 'click'{DATA_REST}""",
)
QUERIES["session_data_compat"] = _feed(
    feeds.session_data,
    DATA_PAYLOAD,
    f"""{DATA_HEAD}, 'Series' AS series_type, ts AS utc, (k % 60)::SMALLINT AS lap, NULL::VARCHAR AS track_status,
          NULL::VARCHAR AS session_status FROM e WHERE et = 'view'
        UNION ALL {DATA_HEAD}, 'StatusSeries', ts, NULL, NULL, 'Started' FROM e WHERE et = 'click'
        UNION ALL {DATA_HEAD}, NULL, NULL, NULL, NULL, NULL FROM e WHERE et = 'purchase'{DATA_REST}""",
    compat=True,
)
QUERIES["clock"] = _feed(
    feeds.extrapolated_clock,
    template('{"Utc":"${utc6}7Z","Remaining":"0${k % 3}:${lpad(k % 60, 2, \'0\')}:00","Extrapolating":${k % 2 = 0}}'),
    """SELECT session_id, line_no, timestamp_ms, ts_ms AS utc, ((k % 3) * 3600000 + (k % 60) * 60000)::BIGINT AS remaining_ms,
         k % 2 = 0 AS extrapolating FROM e""",
)
QUERIES["heartbeat"] = _feed(
    feeds.heartbeat,
    f"""CASE WHEN et = 'error' THEN '{{"Utc":5}}' ELSE {template('{"Utc":"${utc6}7Z"}')} END""",
    "SELECT session_id, line_no, timestamp_ms, CASE WHEN et <> 'error' THEN ts END AS utc FROM e",
)
STREAM = '{"Type":"${et}","Name":"N ${k}","Language":"en","Uri":"u://${k}","Utc":"${utc6}Z"}'
QUERIES["content_streams"] = _feed(
    feeds.content_streams,
    f"""CASE WHEN line_no % 2 = 0 THEN {template('{"Streams":[' + STREAM + ',null,"x"]}')}
        ELSE {template('{"Streams":{"2":' + STREAM + '}}')} END""",
    """SELECT session_id, line_no, timestamp_ms, et AS type, 'N ' || k AS name, 'en' AS language, 'u://' || k AS uri,
         NULL::VARCHAR AS path, utc6 || 'Z' AS utc FROM e""",
)
