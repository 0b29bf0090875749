"""Season, meeting and session lookups over the catalogue tables of ``sources.index``.

Lookups take a table of queries, so any number of them is one job. A query that finds nothing, or too much,
is a row with a status rather than an error.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slipstream.functions import parse
from slipstream.sources.index import session_name

FIRST_SEASON = 2018
MEETING = ["year", "meeting_pos", "meeting_key"]

# Session shorthands of a meeting.
SHORTHANDS = {
    "fp1": "Practice 1",
    "fp2": "Practice 2",
    "fp3": "Practice 3",
    "q": "Qualifying",
    "sq": "Sprint Shootout",
    "sprint": "Sprint",
    "race": "Race",
}


def _start() -> Column:
    return F.struct("start_date", "session_pos")


def available_seasons(spark: SparkSession, meetings: DataFrame, last: int | None = None) -> DataFrame:
    """Years since 2018 for which an index exists."""
    end = F.year(F.current_date()) if last is None else F.lit(last)
    years = spark.range(1).select(F.explode(F.sequence(F.lit(FIRST_SEASON), end)).alias("year"))
    return years.join(meetings, "year", "left_semi")


def meeting_folders(sessions: DataFrame) -> DataFrame:
    """Folder of each meeting, from its first session that has a path."""
    folder = F.min_by("meeting_folder", F.when(F.col("path").isNotNull(), _start()))
    return sessions.groupBy(*MEETING).agg(folder.alias("folder"))


#: Letters of the longest gram of the index over the fields of meetings.
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """All runs of ``size`` letters of a text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    return F.coalesce(F.transform(starts, lambda k: F.substring(text, k, F.lit(size))), F.array().cast("array<string>"))


def _grams_of_fields(fields: str) -> Column:
    """The grams of all sizes up to ``GRAM`` that any field has, and the empty one if there is a field."""
    there = F.transform(F.filter(fields, lambda f: f.isNotNull()), F.lower)
    of_one = lambda f: F.concat(F.array(F.lit("")), *[_grams(f, size) for size in range(1, GRAM + 1)])
    return F.array_distinct(F.flatten(F.transform(there, of_one)))


def _rarest_grams(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """``asked`` with ``_gram``: of the longest grams of a needle, one that fewest meetings of the year have."""
    size = F.least(F.length("_needle"), F.lit(GRAM))
    own = F.when(size == 0, F.array(F.lit("")))
    for k in range(1, GRAM + 1):
        own = own.when(size == k, F.array_distinct(_grams(F.col("_needle"), k)))
    counts = postings.groupBy("year", "_gram").agg(F.count("*").alias("_n"))
    grams = asked.select("*", F.explode(own).alias("_gram")).join(counts, ["year", "_gram"], "left")
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram")))
    return grams.groupBy(*asked.columns).agg(rarest.alias("_r")).select(*asked.columns, F.col("_r.gram").alias("_gram"))


def search_meetings(queries: DataFrame, meetings: DataFrame, sessions: DataFrame) -> DataFrame:
    """Resolve ``query_id, year, text`` to a meeting of that year.

    The folded text must be part of name, location, circuit, country or folder. Several hits resolve only if
    exactly one is no test. ``status`` is found, ambiguous or none; ``candidates`` names all hits.
    """
    places = meetings.join(meeting_folders(sessions), MEETING, "left").select(
        "year", "meeting_pos", "meeting_key", "number", F.col("name").alias("meeting"), "location", "folder",
        F.array("name", "location", "circuit_short_name", "country_name", "folder").alias("_fields"),
    )
    # Every different text is looked up once, by its rarest gram, and only meetings that have it are compared.
    asked = queries.select("year", "text", parse.folded(F.col("text")).alias("_needle")).distinct()
    postings = places.select("*", F.explode(_grams_of_fields("_fields")).alias("_gram"))
    hits = _rarest_grams(asked, postings).join(postings, ["year", "_gram"]).filter(
        F.exists("_fields", lambda f: parse.contains_folded(f, F.col("_needle")))
    )
    place = F.struct("number", "meeting_pos")
    chosen = F.struct("meeting_key", "meeting", "folder")
    race = ~F.contains(F.lower("meeting"), F.lit("testing"))
    label = F.concat("meeting", F.lit(" ("), "location", F.lit(")"))
    found = hits.groupBy("year", "text").agg(
        F.count("*").alias("_hits"),
        F.count_if(race).alias("_races"),
        F.min_by(chosen, place).alias("_any"),
        F.min_by(chosen, F.when(race, place)).alias("_race"),
        F.concat_ws("; ", F.transform(F.sort_array(F.collect_list(F.struct(place.alias("p"), label.alias("l")))), lambda s: s["l"])).alias("candidates"),
    )
    one = F.when(F.col("_hits") == 1, F.col("_any")).when(F.col("_races") == 1, F.col("_race"))
    status = F.when(F.col("_hits").isNull(), "none").when(one.isNotNull(), "found").otherwise("ambiguous")
    return (
        queries.join(found, ["year", "text"], "left")
        .withColumn("_one", one)
        .select(*queries.columns, status.alias("status"), "_one.*", F.coalesce("candidates", F.lit("")).alias("candidates"))
    )


def normalise_sessions(names: DataFrame, column: str = "text") -> DataFrame:
    """Canonical session name per spelling; ``status`` says whether it is known."""
    name = session_name(F.col(column))
    return names.select("*", name.alias("name"), F.when(name.isNull(), "unknown").otherwise("ok").alias("status"))


def search_sessions(queries: DataFrame, sessions: DataFrame, compat: bool = False) -> DataFrame:
    """Resolve ``query_id, year, meeting_key, text`` to a session of that meeting.

    An exact name beats a partial one, then the earlier start counts. ``compat`` takes the earliest session
    whose name contains the text.
    """
    return _found_sessions(queries, sessions, compat).drop("_path")


def _found_sessions(queries: DataFrame, sessions: DataFrame, compat: bool) -> DataFrame:
    asked = queries.withColumn("_needle", F.lower("text"))
    named = sessions.select(
        "year", "meeting_key", "session_pos", "start_date", "session_key", "name", "session_folder", F.col("path").alias("_path")
    )
    hits = asked.join(named, ["year", "meeting_key"]).filter(parse.contains_folded(F.col("name"), F.col("_needle")))
    partial = F.lit(0) if compat else F.when(F.lower("name") == F.col("_needle"), 0).otherwise(1)
    best = F.min_by(F.struct("session_key", "name", "session_folder", "start_date", "_path"), F.struct(partial, "start_date", "session_pos"))
    found = hits.groupBy("query_id").agg(best.alias("_s"))
    return queries.join(found, "query_id", "left").select(
        *queries.columns, F.when(F.col("_s").isNull(), "none").otherwise("found").alias("status"), "_s.*"
    )


def sessions_by_type(sessions: DataFrame) -> DataFrame:
    """One column per session shorthand with the key of the earliest session of that exact name."""
    return sessions.groupBy(*MEETING).agg(
        *[F.min_by("session_key", F.when(F.col("name") == n, _start())).alias(s) for s, n in SHORTHANDS.items()]
    )


def weekend_span(sessions: DataFrame) -> DataFrame:
    """First session's start, and the last session's end or else its start."""
    return sessions.groupBy(*MEETING).agg(
        F.min("start_date").alias("weekend_start"),
        F.max_by(F.coalesce("end_date", "start_date"), _start()).alias("weekend_end"),
    )


def season_listing(meetings: DataFrame, sessions: DataFrame) -> DataFrame:
    """Meetings of each year in order, with their rank in it, span, and session names in order."""
    names = F.transform(
        F.sort_array(F.collect_list(F.struct("start_date", "session_pos", F.coalesce("name", F.lit("None")).alias("n")))),
        lambda s: s["n"],
    )
    listed = sessions.groupBy(*MEETING).agg(
        F.concat_ws(", ", names).alias("sessions"),
        F.min("start_date").alias("weekend_start"),
        F.max_by(F.coalesce("end_date", "start_date"), _start()).alias("weekend_end"),
    )
    return (
        meetings.join(listed, MEETING, "left")
        .select("year", "number", "meeting_pos", "meeting_key", "name", "location", "weekend_start", "weekend_end", "sessions")
        .withColumn("meeting_rank", F.row_number().over(Window.partitionBy("year").orderBy("number", "meeting_pos")))
        .orderBy("year", "number", "meeting_pos")
    )


def ordered_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions by meeting and start, with their rank in the meeting."""
    rank = F.row_number().over(Window.partitionBy(*MEETING[:2]).orderBy("start_date", "session_pos"))
    return sessions.withColumn("session_rank", rank).orderBy(*MEETING[:2], "start_date", "session_pos")


def resolve_sessions(queries: DataFrame, meetings: DataFrame, sessions: DataFrame) -> DataFrame:
    """Resolve ``query_id, year, meeting, session`` texts to ``session_id``, with a ``status`` per query.

    The meeting is searched as by :func:`search_meetings`; any accepted spelling of a session name counts, other texts as
    they are. ``status`` is found, no meeting, ambiguous meeting, no session, or no files for a session without a path.
    """
    places = search_meetings(queries.select("query_id", "year", F.col("meeting").alias("text")), meetings, sessions)
    placed = places.select("query_id", F.col("status").alias("_meeting"), "meeting_key")
    asked = queries.join(placed, "query_id").withColumn("text", F.coalesce(session_name(F.col("session")), F.trim("session")))
    found = _found_sessions(asked.select("query_id", "year", "meeting_key", "text"), sessions, compat=False)
    status = (
        F.when(F.col("_meeting") == "none", "no meeting")
        .when(F.col("_meeting") == "ambiguous", "ambiguous meeting")
        .when(F.col("status") == "none", "no session")
        .when(F.col("_path").isNull(), "no files")
        .otherwise("found")
    )
    rows = asked.select("query_id", "_meeting").join(found.select("query_id", "status", "_path"), "query_id")
    return queries.join(rows.select("query_id", status.alias("status"), F.rtrim("_path", F.lit("/")).alias("session_id")), "query_id", "left")


def feed_lookup(queries: DataFrame, meetings: DataFrame, sessions: DataFrame, rows: DataFrame) -> DataFrame:
    """From names to a feed: the feed's ``rows`` of each query's session, beside the query and its ``lookup_status``.

    A query without rows is one row with nulls, with status ``no rows`` if its session was found. Columns of the feed
    that clash with the query's get ``_row``. Queries are the small side; a busy session's rows are split by the adaptive
    join.
    """
    taken = {*queries.columns, "lookup_status"}
    named = {c: f"{c}_row" if c in taken else c for c in rows.columns if c != "session_id"}
    asked = resolve_sessions(queries, meetings, sessions).withColumnRenamed("status", "lookup_status")
    found = asked.join(rows.withColumnsRenamed(named).withColumn("_there", F.lit(True)), "session_id", "left")
    status = F.when((F.col("lookup_status") == "found") & F.col("_there").isNull(), "no rows").otherwise(F.col("lookup_status"))
    return found.withColumn("lookup_status", status).select(*queries.columns, "lookup_status", "session_id", *named.values())


def with_session(rows: DataFrame, sessions: DataFrame, meetings: DataFrame) -> DataFrame:
    """Feed rows with the names of their session and meeting, matched by the session's path.

    A plain join: the catalogue has one row per session, so it is broadcast where it is small, and elsewhere a busy
    session is split by the adaptive join.
    """
    named = sessions.filter("path IS NOT NULL").select(
        F.rtrim("path", F.lit("/")).alias("session_id"), "year", "meeting_pos", F.col("name").alias("session_name"), "session_key"
    )
    names = meetings.select("year", "meeting_pos", F.col("name").alias("meeting_name"), "country_name")
    places = named.join(names, ["year", "meeting_pos"], "left").drop("meeting_pos")
    return rows.join(places, "session_id", "left")


def messages_per_session(messages: DataFrame, sessions: DataFrame) -> DataFrame:
    """Race control messages counted per session of a season, beside the season's mean.

    ``sessions`` holds ``year, session_id``; a session without messages counts as zero.
    """
    counted = messages.groupBy("session_id").agg(F.count("*").alias("n"))
    per_session = sessions.join(counted, "session_id", "left").select(
        "year", "session_id", F.coalesce("n", F.lit(0)).alias("messages")
    )
    mean = per_session.groupBy("year").agg(F.avg("messages").alias("season_mean"))
    return per_session.join(mean, "year").select("year", "session_id", "messages", F.round("season_mean", 6).alias("season_mean"))


def lap_totals(laps: DataFrame) -> DataFrame:
    """Per session: the last race length seen and the highest lap reached, 0 where there is none."""
    place = F.struct("block_no", "line_no", "entry_no")
    total = F.max_by("total_laps", F.when(F.col("total_laps").isNotNull(), place))
    return laps.groupBy("session_id").agg(
        F.coalesce(total, F.lit(0)).alias("total_laps"),
        F.coalesce(F.max("lap").cast("int"), F.lit(0)).alias("current_lap"),
    )
