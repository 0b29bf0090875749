"""Catalogue queries: a region is a season, a nation a meeting, and its orders of one month a session."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.operators import catalog, feeds, quality
from slipstream.plans.feed_queries import CAR_PAYLOAD, CAR_SQL, Query
from slipstream.plans.keyframe_queries import _report_sql
from slipstream.plans.lines import EVENTS_SQL, STATES_SQL, car_documents, car_states, entries, template
from slipstream.sources import archive, index

NAMES = "array('Practice 1', 'Day 2', ' practice 3', 'Qualifying', 'Sprint Qualifying', 'Sprint', 'Race', 'High Speed Track Test', 'Warm-Up')"
PATH = "concat(2018 + n_regionkey, '/', n_name, '_Grand_Prix/', mi, '_', replace(trim(name), ' ', '_'), '/')"
SESSION = f"""to_json(named_struct(
  'Key', if(mi % 10 = 0, -1, n_nationkey * 10000 + mi % 1000),
  'Type', element_at(array('Practice', 'Qualifying', 'Race', 'Demo'), mi % 4 + 1),
  'Number', if(mi % 10 = 0, null, mi % 5 + 1), 'Name', if(mi % 10 = 0, null, name),
  'StartDate', date_format(first_order, "yyyy-MM-dd'T'HH:mm:ss"),
  'EndDate', if(mi % 3 = 0, null, date_format(last_order, "yyyy-MM-dd'T'HH:mm:ss")),
  'GmtOffset', if(mi % 2 = 0, '03:00:00', '-05:30:00'), 'Path', if(mi % 10 = 0, null, {PATH})))"""


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted by nation and month, with the nation's names: the sessions of the catalogue."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    # Per customer first: a busy customer is then at most one row per month in the join.
    bought = orders.groupBy("o_custkey", month.alias("mi")).agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    grouped = (
        bought.join(customer, bought.o_custkey == customer.c_custkey)
        .groupBy("c_nationkey", "mi")
        .agg(F.min("first_order").alias("first_order"), F.max("last_order").alias("last_order"))
    )
    named = grouped.join(nation, grouped.c_nationkey == nation.n_nationkey)
    return named.withColumn("name", F.expr(f"element_at({NAMES}, mi % 9 + 1)"))


def season_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index document per season; it lists at most the nations of a region and their calendar months."""
    sessions = _months(spark, sf_dir).select("n_nationkey", "n_name", "n_regionkey", "mi", F.expr(SESSION).alias("piece"))
    gathered = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("mi")).alias("o"), "piece"))), lambda s: s["piece"])
    meetings = sessions.groupBy("n_nationkey", "n_name", "n_regionkey").agg(F.concat_ws(",", gathered).alias("sessions"))
    head = template(
        '{"Sessions":[${sessions}],"Key":${100 + n_nationkey},"Code":"C${n_nationkey}","Number":${n_nationkey DIV 5 % 3 + 1},'
        '"Location":"City ${n_nationkey}","OfficialName":"FORMULA ${n_name}",'
        '"Name":"${if(n_nationkey < 5, \'Pre-Season Testing\', concat(n_name, \' Grand Prix\'))}",'
        '"Country":{"Key":${n_nationkey},"Code":"N${n_nationkey}","Name":"${n_name}"},'
        '"Circuit":{"Key":${n_nationkey + 50},"ShortName":"Circuit ${n_nationkey}"}}'
    )
    meetings = meetings.select("n_regionkey", "n_nationkey", F.expr(head).alias("piece"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("n_nationkey", "piece"))), lambda s: s["piece"])
    seasons = meetings.groupBy("n_regionkey").agg(F.concat_ws(",", listed).alias("body"))
    doc = template('{"Year":${2018 + n_regionkey},"Meetings":[${body}]}')
    return archive.decode_documents(seasons.select(F.lit("").alias("session_id"), F.expr(doc).alias("doc")))


def _catalogue(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = season_documents(spark, sf_dir)
    return index.meetings(docs), index.sessions(docs)


NAMES_SQL = NAMES.replace("array(", "[").replace(")", "]")
KNOWN_SQL = """CASE lower(trim(name)) WHEN 'practice 1' THEN 'Practice 1' WHEN 'day 2' THEN 'Practice 2' WHEN 'practice 3' THEN 'Practice 3'
  WHEN 'qualifying' THEN 'Qualifying' WHEN 'sprint qualifying' THEN 'Sprint Shootout' WHEN 'sprint' THEN 'Sprint' WHEN 'race' THEN 'Race'
  WHEN 'high speed track test' THEN 'High Speed Track Test' END"""
CATALOGUE_SQL = f"""g AS (
  SELECT c_nationkey, year(o_orderdate) * 12 + month(o_orderdate) AS mi, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
h AS (SELECT *, ({NAMES_SQL})[(mi % 9 + 1)::BIGINT] AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY mi DESC) - 1 AS rn
      FROM g JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT (2018 + n_regionkey)::INTEGER AS "year",
        (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INTEGER AS meeting_pos, 100 + n_nationkey AS meeting_key,
        'C' || n_nationkey AS code, (n_nationkey // 5 % 3 + 1)::INTEGER AS number,
        CASE WHEN n_nationkey < 5 THEN 'Pre-Season Testing' ELSE n_name || ' Grand Prix' END AS name, 'City ' || n_nationkey AS location,
        'FORMULA ' || n_name AS official_name, n_nationkey AS country_key, 'N' || n_nationkey AS country_code, n_name AS country_name,
        n_nationkey + 50 AS circuit_key, 'Circuit ' || n_nationkey AS circuit_short_name
      FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM g)),
p AS (SELECT h.*, (2018 + n_regionkey)::INTEGER AS "year", 100 + n_nationkey AS meeting_key,
        CASE WHEN mi % 10 <> 0 THEN (2018 + n_regionkey) || '/' || n_name || '_Grand_Prix/' || mi || '_' || replace(trim(name), ' ', '_') || '/' END AS path
      FROM h),
s AS (SELECT "year", m.meeting_pos, meeting_key, rn::INTEGER AS session_pos,
        (CASE WHEN mi % 10 = 0 THEN -1 ELSE n_nationkey * 10000 + mi % 1000 END)::INTEGER AS session_key,
        (['Practice', 'Qualifying', 'Race', 'Demo'])[(mi % 4 + 1)::BIGINT] AS type,
        (CASE WHEN mi % 10 <> 0 THEN mi % 5 + 1 END)::INTEGER AS number, CASE WHEN mi % 10 <> 0 THEN p.name END AS raw_name,
        CASE WHEN mi % 10 <> 0 THEN {KNOWN_SQL.replace("name", "p.name")} END AS name, first_order AS start_date,
        CASE WHEN mi % 3 <> 0 THEN last_order END AS end_date, (CASE WHEN mi % 2 = 0 THEN 10800 ELSE -19800 END)::INTEGER AS gmt_offset_s,
        path, split_part(path, '/', 1) AS path_year, split_part(path, '/', 2) AS meeting_folder, split_part(path, '/', 3) AS session_folder
      FROM p JOIN m USING ("year", meeting_key)),
w AS (SELECT "year", meeting_pos, meeting_key, min(start_date) AS weekend_start,
        arg_max(coalesce(end_date, start_date), start_date) AS weekend_end,
        arg_min(meeting_folder, start_date) FILTER (path IS NOT NULL) AS folder FROM s GROUP BY ALL)"""

QUERIES: dict[str, Query] = {}


def _query(name: str, build: Callable[[DataFrame, DataFrame], DataFrame], sql: str) -> None:
    QUERIES[name] = Query(lambda spark, sf_dir: build(*_catalogue(spark, sf_dir)), f"WITH {CATALOGUE_SQL} {sql}")


_query("meetings", lambda m, s: m, "SELECT * FROM m")
_query("sessions", lambda m, s: catalog.ordered_sessions(s), 'SELECT *, row_number() OVER (PARTITION BY "year", meeting_pos ORDER BY start_date, session_pos)::INTEGER AS session_rank FROM s')
_query("meeting_folders", lambda m, s: catalog.meeting_folders(s), 'SELECT "year", meeting_pos, meeting_key, folder FROM w')
_query(
    "weekend_span",
    lambda m, s: catalog.weekend_span(s),
    'SELECT "year", meeting_pos, meeting_key, weekend_start, weekend_end FROM w',
)
_query(
    "sessions_by_type",
    lambda m, s: catalog.sessions_by_type(s),
    'SELECT "year", meeting_pos, meeting_key, '
    + ", ".join(
        f"arg_min(session_key, start_date) FILTER (name = '{n}') AS {k}" for k, n in catalog.SHORTHANDS.items()
    )
    + " FROM s GROUP BY ALL",
)
_query(
    "season_list",
    catalog.season_listing,
    """SELECT "year", number, m.meeting_pos, meeting_key, m.name, location, weekend_start, weekend_end, sessions,
         row_number() OVER (PARTITION BY "year" ORDER BY number, m.meeting_pos)::INTEGER AS meeting_rank
       FROM m JOIN w USING ("year", meeting_key) JOIN (SELECT "year", meeting_key,
         string_agg(coalesce(name, 'None'), ', ' ORDER BY start_date) AS sessions FROM s GROUP BY ALL) USING ("year", meeting_key)""",
)
_query(
    "session_names",
    lambda m, s: catalog.normalise_sessions(s.select(F.col("raw_name").alias("text")).distinct()),
    "SELECT DISTINCT raw_name AS text, name, CASE WHEN name IS NULL THEN 'unknown' ELSE 'ok' END AS status FROM s",
)
_query(
    "quality_sessions",
    lambda m, s: quality.session_report(s),
    _report_sql(
        'SELECT "year"::VARCHAR AS session_id, type, raw_name, name FROM s',
        {"session_type": "type = 'Demo'", "session_name": "raw_name IS NOT NULL AND name IS NULL"},
    ),
)


def _meeting_search(m: DataFrame, s: DataFrame) -> DataFrame:
    """Asks for every country and city by name, and per season for some words."""
    country = m.select(F.concat(F.lit("c"), "country_key").alias("query_id"), "year", F.concat(F.lit("  "), F.upper("country_name")).alias("text"))
    city = m.select(F.concat(F.lit("l"), "country_key").alias("query_id"), "year", F.lower("location").alias("text"))
    words = m.select("year").distinct()
    words = words.select("year", F.explode(F.array(*map(F.lit, ["Grand Prix", "testing", "Nowhere", "_grand_"]))).alias("text"))
    words = words.select(F.concat("year", "text").alias("query_id"), "year", "text")
    return catalog.search_meetings(country.unionByName(city).unionByName(words), m, s)


_query(
    "meeting_search",
    _meeting_search,
    """, q AS (SELECT 'c' || country_key AS query_id, "year", '  ' || upper(country_name) AS text FROM m
             UNION ALL SELECT 'l' || country_key, "year", lower(location) FROM m
             UNION ALL SELECT y."year" || t, y."year", t FROM (SELECT DISTINCT "year" FROM m) y,
               (VALUES ('Grand Prix'), ('testing'), ('Nowhere'), ('_grand_')) AS v(t)),
    hits AS (SELECT q.query_id, m.*, folder, name NOT ILIKE '%testing%' AS race FROM q JOIN m USING ("year") JOIN w USING ("year", meeting_key)
             WHERE contains(lower(concat_ws(chr(1), m.name, m.location, m.circuit_short_name, m.country_name, folder)), lower(trim(q.text)))),
    n AS (SELECT query_id, count(*) AS hits, count(*) FILTER (race) AS races, arg_min(meeting_key, (number, meeting_pos)) AS any_key,
            arg_min(meeting_key, (number, meeting_pos)) FILTER (race) AS race_key,
            string_agg(name || ' (' || location || ')', '; ' ORDER BY number, meeting_pos) AS candidates FROM hits GROUP BY query_id),
    o AS (SELECT q.*, n.hits, coalesce(candidates, '') AS candidates,
            CASE WHEN hits = 1 THEN any_key WHEN races = 1 THEN race_key END AS meeting_key FROM q LEFT JOIN n USING (query_id))
    SELECT query_id, o."year", text, CASE WHEN hits IS NULL THEN 'none' WHEN o.meeting_key IS NULL THEN 'ambiguous' ELSE 'found' END AS status,
      o.meeting_key, m.name AS meeting, folder, candidates
    FROM o LEFT JOIN m ON m."year" = o."year" AND m.meeting_key = o.meeting_key
      LEFT JOIN w ON w."year" = o."year" AND w.meeting_key = o.meeting_key""",
)


def _session_search(compat: bool) -> Callable[[DataFrame, DataFrame], DataFrame]:
    def build(m: DataFrame, s: DataFrame) -> DataFrame:
        texts = F.explode(F.array(*map(F.lit, ["Sprint", "race", "practice", "Nothing", ""]))).alias("text")
        asked = m.select("year", "meeting_key", texts)
        asked = asked.select(F.concat_ws("-", "year", "meeting_key", "text").alias("query_id"), "year", "meeting_key", "text")
        return catalog.search_sessions(asked, s, compat=compat)

    return build


def _session_search_sql(order: str) -> str:
    return f""", q AS (SELECT "year" || '-' || meeting_key || '-' || t AS query_id, "year", meeting_key, t AS text FROM m,
        (VALUES ('Sprint'), ('race'), ('practice'), ('Nothing'), ('')) AS v(t)),
      f AS (SELECT q.query_id, session_key, name, session_folder, start_date FROM q JOIN s USING ("year", meeting_key)
            WHERE contains(lower(name), lower(text))
            QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY {order} start_date) = 1)
      SELECT q.*, CASE WHEN f.query_id IS NULL THEN 'none' ELSE 'found' END AS status, session_key, name, session_folder, start_date
      FROM q LEFT JOIN f USING (query_id)"""


_query("session_search", _session_search(False), _session_search_sql("CASE WHEN lower(name) = lower(text) THEN 0 ELSE 1 END,"))
_query("session_search_compat", _session_search(True), _session_search_sql(""))


def _season_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    piece = F.expr(template('{"Year":${2018 + r_regionkey},"Path":"${2018 + r_regionkey}/"}'))
    body = F.concat_ws(",", F.sort_array(F.collect_list(piece)))
    docs = region.agg(F.concat(F.lit('\ufeff{"Years":['), body, F.lit("]}")).alias("doc"))
    return index.years(archive.decode_documents(docs))


QUERIES["season_years"] = Query(
    _season_years, """SELECT (2018 + r_regionkey)::INTEGER AS "year", (2018 + r_regionkey) || '/' AS path FROM region"""
)
QUERIES["seasons"] = Query(
    lambda spark, sf_dir: catalog.available_seasons(spark, _catalogue(spark, sf_dir)[0]),
    f"""WITH {CATALOGUE_SQL} SELECT DISTINCT "year" FROM m WHERE "year" BETWEEN 2018 AND year(current_date)""",
)

# Feeds of a session

FEED = f"element_at(array({', '.join(repr(f) for f in index.KNOWN_FEEDS[:15])}, 'PitStop', 'CarData.z', 'Position.z', 'DriverTracker', 'TlaRcm'), car)"
FEED_PIECE = template('"${' + FEED + '}":{"KeyFramePath":"${' + FEED + '}.json","StreamPath":"${' + FEED + '}.jsonStream"}')
FEED_SQL = "([" + FEED.removeprefix("element_at(array(").removesuffix("), car)") + "])[car]"


def _offered(spark: SparkSession, sf_dir: str, before: str, after: str) -> DataFrame:
    docs = car_documents(spark, sf_dir, f"CASE WHEN k % 3 <> 0 THEN {FEED_PIECE} END", before, after)
    return index.session_feeds(archive.decode_documents(docs))


def _missing_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = car_states(spark, sf_dir).select("session_id", F.expr(FEED).alias("feed"))
    return index.missing_feeds(requested, _offered(spark, sf_dir, '{"Feeds":{', "}}"))


OFFERED_SQL = f"""SELECT session_id, f AS feed, f || '.json' AS keyframe_path, f || '.jsonStream' AS stream_path,
  contains(f, '.z') AS compressed, f NOT IN ('PitStop', 'DriverTracker') AS known FROM (SELECT *, {FEED_SQL} AS f FROM st WHERE k % 3 <> 0)"""
QUERIES["session_feeds"] = Query(
    lambda spark, sf_dir: _offered(spark, sf_dir, '{"Feeds":{', "}}"), f"WITH {STATES_SQL} {OFFERED_SQL}"
)
QUERIES["session_feeds_bare"] = Query(
    lambda spark, sf_dir: _offered(spark, sf_dir, "{", "}"), f"WITH {STATES_SQL} {OFFERED_SQL}"
)
QUERIES["available_feeds"] = Query(
    lambda spark, sf_dir: index.available_feeds(_offered(spark, sf_dir, '{"Feeds":{', "}}")),
    f"WITH {STATES_SQL} SELECT session_id, feed, compressed FROM ({OFFERED_SQL}) WHERE known",
)
QUERIES["missing_feeds"] = Query(
    _missing_feeds, f"WITH {STATES_SQL} SELECT session_id, {FEED_SQL} AS feed FROM st WHERE k % 3 = 0"
)

# Feed rows with their session and meeting


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a feed row of its nation's month."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.withColumn("mi", F.year("o_orderdate") * 12 + F.month("o_orderdate"))
    rows = rows.withColumn("name", F.expr(f"element_at({NAMES}, mi % 9 + 1)"))
    return rows.select(F.rtrim(F.expr(PATH), F.lit("/")).alias("session_id"), F.col("o_orderkey").alias("line_no"), F.col("o_orderstatus").alias("order_status"))


def _rows_with_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a feed row, found again through the session's path."""
    meetings, sessions = _catalogue(spark, sf_dir)
    return catalog.with_session(_order_rows(spark, sf_dir).withColumnRenamed("order_status", "status"), sessions, meetings)


QUERIES["rows_with_session"] = Query(
    _rows_with_session,
    f"""WITH {CATALOGUE_SQL}, o AS (SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS mi FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey),
        x AS (SELECT (2018 + n_regionkey) || '/' || n_name || '_Grand_Prix/' || mi || '_' ||
                replace(trim(({NAMES_SQL})[(mi % 9 + 1)::BIGINT]), ' ', '_') AS session_id, o_orderkey AS line_no, o_orderstatus AS status FROM o)
        SELECT x.*, s."year", s.name AS session_name, s.session_key, m.name AS meeting_name, m.country_name
        FROM x LEFT JOIN s ON s.path = x.session_id || '/' LEFT JOIN m ON m."year" = s."year" AND m.meeting_key = s.meeting_key""",
)



def _feed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asks each meeting, by its country, for some spelled sessions; the feed's rows are the orders of a month."""
    meetings, sessions = _catalogue(spark, sf_dir)
    texts = F.explode(F.array(*map(F.lit, ["day 2", " SPRINT qualifying", "Race", "Nothing"]))).alias("session")
    asked = meetings.select("year", F.col("country_name").alias("meeting"), texts)
    nowhere = meetings.select("year", F.lit("Nowhere").alias("meeting"), F.lit("Race").alias("session")).distinct()
    asked = asked.unionByName(nowhere).select(F.concat_ws("-", "year", "meeting", "session").alias("query_id"), "*")
    return catalog.feed_lookup(asked, meetings, sessions, _order_rows(spark, sf_dir))


QUERIES["feed_lookup"] = Query(
    _feed_lookup,
    f"""WITH {CATALOGUE_SQL}, o AS (SELECT *, year(o_orderdate) * 12 + month(o_orderdate) AS mi FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey),
        x AS (SELECT (2018 + n_regionkey) || '/' || n_name || '_Grand_Prix/' || mi || '_' ||
                replace(trim(({NAMES_SQL})[(mi % 9 + 1)::BIGINT]), ' ', '_') AS session_id, o_orderkey AS line_no, o_orderstatus AS status FROM o),
        q AS (SELECT "year", country_name AS meeting, t AS session FROM m, (VALUES ('day 2'), (' SPRINT qualifying'), ('Race'), ('Nothing')) AS v(t)
              UNION SELECT "year", 'Nowhere', 'Race' FROM m),
        hits AS (SELECT q.*, m.meeting_key, m.number, m.meeting_pos, m.name NOT ILIKE '%testing%' AS race FROM q JOIN m USING ("year") JOIN w USING ("year", meeting_key)
             WHERE contains(lower(concat_ws(chr(1), m.name, m.location, m.circuit_short_name, m.country_name, w.folder)), lower(trim(q.meeting)))),
        n AS (SELECT "year", meeting, session, count(*) AS hits, count(*) FILTER (race) AS races,
                arg_min(meeting_key, (number, meeting_pos)) AS any_key, arg_min(meeting_key, (number, meeting_pos)) FILTER (race) AS race_key
              FROM hits GROUP BY ALL),
        k AS (SELECT q.*, n.hits, CASE WHEN hits = 1 THEN any_key WHEN races = 1 THEN race_key END AS meeting_key,
                CASE lower(trim(q.session)) WHEN 'day 2' THEN 'Practice 2' WHEN 'sprint qualifying' THEN 'Sprint Shootout' ELSE q.session END AS wanted
              FROM q LEFT JOIN n USING ("year", meeting, session)),
        f AS (SELECT k."year", k.meeting, k.session, s.path FROM k JOIN s USING ("year", meeting_key) WHERE contains(lower(s.name), lower(k.wanted))
              QUALIFY row_number() OVER (PARTITION BY k."year", k.meeting, k.session
                ORDER BY CASE WHEN lower(s.name) = lower(k.wanted) THEN 0 ELSE 1 END, s.start_date) = 1),
        r AS (SELECT k.*, f.path, CASE WHEN k.hits IS NULL THEN 'no meeting' WHEN k.meeting_key IS NULL THEN 'ambiguous meeting'
                WHEN f."year" IS NULL THEN 'no session' WHEN f.path IS NULL THEN 'no files' ELSE 'found' END AS status
              FROM k LEFT JOIN f USING ("year", meeting, session))
        SELECT r."year" || '-' || r.meeting || '-' || r.session AS query_id, r."year", r.meeting, r.session,
          CASE WHEN r.status = 'found' AND x.line_no IS NULL THEN 'no rows' ELSE r.status END AS lookup_status,
          rtrim(r.path, '/') AS session_id, x.line_no, x.status AS order_status
        FROM r LEFT JOIN x ON r.status = 'found' AND x.session_id = rtrim(r.path, '/')""",
)

QUERIES["quality_ranges"] = Query(
    lambda spark, sf_dir: quality.range_report(feeds.car_data(entries(spark, sf_dir, CAR_PAYLOAD)), {"speed": (0, 50), "gear": (0, 7), "drs": (2, 255)}),
    f"WITH {EVENTS_SQL} "
    + _report_sql(CAR_SQL, {"speed_range": "speed NOT BETWEEN 0 AND 50", "gear_range": "gear NOT BETWEEN 0 AND 7", "drs_range": "drs NOT BETWEEN 2 AND 255"}),
)


# Weather readings and tracker lines with values that fit no number for some k.
WEATHER_TYPES = {"AirTemp": "double", "Humidity": "double", "WindDirection": "int"}
WEATHER_LINE = template('{"AirTemp":"${if(k % 10 = 3, \'warm\', CAST(v AS STRING))}","Humidity":"","WindDirection":"${if(k % 4 = 0, \'1.5\', CAST(k AS STRING))}"}')
QUERIES["quality_types"] = Query(
    lambda spark, sf_dir: quality.type_report(entries(spark, sf_dir, WEATHER_LINE), WEATHER_TYPES),
    f"WITH {EVENTS_SQL} "
    + _report_sql("SELECT * FROM e", {"AirTemp": "k % 10 = 3", "Humidity": "true", "WindDirection": "k % 4 = 0"}),
)
TRACKER_TYPES = {"LapState": "smallint", "Position": "int"}
TRACKER_LINE = template('{"Lines":{"${car}":{"LapState":${k * 1000}},"${car + 20}":{"Position":"P${k}"},"x":null}}')
QUERIES["quality_line_types"] = Query(
    lambda spark, sf_dir: quality.type_report(entries(spark, sf_dir, TRACKER_LINE), TRACKER_TYPES, field="Lines"),
    f"WITH {EVENTS_SQL} "
    + _report_sql(
        "SELECT session_id, k * 1000 > 32767 AS bad_state, false AS bad_position FROM e UNION ALL SELECT session_id, false, true FROM e",
        {"LapState": "bad_state", "Position": "bad_position"},
    ),
)
