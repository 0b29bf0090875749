"""From a mirrored archive to feed tables, and from those to analyses that span sessions.

Archive text is decoded once and written as Parquet by year and session; joins and reports then read only the columns,
years and cars they need. A feed that a session, or the whole archive, does not have is an empty table and a row of the
report, not an error.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.functions.jsonwalk import ENTRY
from slipstream.operators import catalog, feeds, keyframes, quality
from slipstream.operators.asof import telemetry_on_track
from slipstream.sources import archive, index

RAW = "session_id string, block_no long, line_no long, entry_no int, timestamp_ms long, payload string"
DOCS = "session_id string, doc string"
#: Tables that are read off a feed's entries beside its own: folder, feed and function.
DERIVED = {
    "DriverRaceInfo.starting_grid": ("DriverRaceInfo", feeds.starting_grid),
    "LapCount.lap_totals": ("LapCount", lambda raw: catalog.lap_totals(feeds.lap_count(raw))),
}


def build_feed_tables(
    spark: SparkSession,
    root: str,
    out: str,
    names: Sequence[str] = tuple(feeds.FEEDS),
    sessions: Sequence[str] = ("*/*/*",),
    on_bad: str = "raise",
) -> dict[str, str]:
    """Write the stream tables of the named feeds, each from one scan over all sessions. Returns the folders.

    Sessions that were written before and are not read now stay as they are.
    """
    return {
        name: archive.write_feed(feeds.read_feed(spark, root, name, sessions, on_bad), out, name) for name in names
    }


MANIFEST = f"{archive.FILES}, rows long, read_at timestamp"


def manifest(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The files a written table was built from, as they were when they were last read: path, size, modification time, and
    the rows of their session. One row per file."""
    try:
        every = spark.read.schema(MANIFEST).parquet(_manifest_folder(out, name))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    rest = [c for c in every.columns if c != "path"]
    last = every.groupBy("path").agg(F.max_by(F.struct(*rest), "read_at").alias("f"))
    return last.select("path", "f.*").select(*every.columns)


def _manifest_folder(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/manifest.{name}"


def changed_files(spark: SparkSession, root: str, out: str, name: str, sessions: Sequence[str] = ("*/*/*",)) -> DataFrame:
    """The files of a feed that are new, or of another size or time than when they were read; nothing in them is read."""
    there = archive.list_files(spark, archive.feed_paths(root, feeds.FEEDS[name].stream_file, sessions))
    return there.join(manifest(spark, out, name), ["session_id", "path", "length", "modified"], "left_anti")


def update_feed_tables(
    spark: SparkSession,
    root: str,
    out: str,
    names: Sequence[str] = tuple(feeds.FEEDS),
    sessions: Sequence[str] = ("*/*/*",),
    on_bad: str = "raise",
) -> dict[str, int]:
    """Bring the stream tables up to date: only files that are new or changed are read. Returns how many, per feed.

    The list of these files goes through the driver, which lists them for a scan anyway. A file is noted once its session is
    written, so a job that fails is done again by the next one.
    """
    read = {}
    for name in names:
        files = [tuple(r) for r in changed_files(spark, root, out, name, sessions).collect()]
        read[name] = len(files)
        if not files:
            continue
        found = spark.createDataFrame(files, archive.FILES)
        changed = sorted({session for session, *_ in files})
        archive.write_feed(feeds.read_feed(spark, root, name, changed, on_bad), out, name, replaced=changed)
        rows = archive.read_written(spark, out, name, table_schema(spark, name)).groupBy(F.col("session").alias("session_id")).agg(F.count("*").alias("rows"))
        noted = found.join(rows, "session_id", "left").withColumns({"rows": F.coalesce("rows", F.lit(0)), "read_at": F.current_timestamp()})
        noted.select("session_id", "path", "length", "modified", "rows", "read_at").write.mode("append").parquet(_manifest_folder(out, name))
    return read


def write_with_report(
    spark: SparkSession, root: str, out: str, name: str, sessions: Sequence[str] = ("*/*/*",), types: dict[str, str] | None = None
) -> dict[str, int]:
    """Write the sound entries of a feed, and return what the scan has seen of its lines and values on the way.

    One job: ``lines`` and a count for each fault of a line and, as in ``quality.type_report``, for each JSON key of ``types``
    whose value does not fit. A busy feed of whole documents has line counts only.
    """
    feed = feeds.FEEDS[name]
    lines = archive.read_stream_lines(spark, archive.feed_paths(root, feed.stream_file, sessions))
    compressed = ".z." in feed.stream_file
    judged, of_lines = quality.observed(archive.judged_lines(lines, compressed), quality.line_rules())
    sound = judged.filter("fault IS NULL")
    if feed.flatten_docs is not None:
        table, of_values = feed.flatten_docs(sound.select(*ENTRY[:3], "timestamp_ms", "doc")), None
    else:
        raw = archive.entries_of_documents(sound) if compressed else sound.select(*ENTRY[:3], F.lit(0).alias("entry_no"), "timestamp_ms", F.col("doc").alias("payload"))
        of_values = None
        if types:
            raw, of_values = quality.observed(raw, quality.payload_rules(types))
        table = feed.flatten(raw)
    archive.write_feed(table, out, name)
    found = dict(of_lines.get)
    return {"lines": found.pop("rows"), **found, **({k: v for k, v in of_values.get.items() if k != "rows"} if of_values is not None else {})}


def build_derived_tables(
    spark: SparkSession, root: str, out: str, sessions: Sequence[str] = ("*/*/*",), on_bad: str = "raise"
) -> dict[str, str]:
    """Write the starting grid and the lap totals of each session. Returns the folders."""
    return {
        name: archive.write_feed(derive(archive.read_entries(spark, root, feeds.FEEDS[feed].stream_file, sessions, on_bad)), out, name)
        for name, (feed, derive) in DERIVED.items()
    }


def build_keyframe_tables(
    spark: SparkSession,
    root: str,
    out: str,
    names: Sequence[str] = tuple(keyframes.KEYFRAMES),
    sessions: Sequence[str] = ("*/*/*",),
    on_bad: str = "raise",
) -> dict[str, str]:
    """Write the keyframe tables of the named feeds, ``<feed>.keyframe_<table>``. Returns the folders."""
    written = {}
    for name in names:
        docs = archive.read_keyframes(spark, root, feeds.FEEDS[name].keyframe_file, sessions, on_bad)
        for table, flatten in keyframes.KEYFRAMES[name].items():
            written[f"{name}.keyframe_{table}"] = archive.write_feed(flatten(docs), out, f"{name}.keyframe_{table}")
    return written


def table_schema(spark: SparkSession, name: str) -> T.StructType:
    """The columns of a table by its folder name."""
    if name in DERIVED:
        return DERIVED[name][1](spark.createDataFrame([], RAW)).schema
    feed, _, table = name.partition(".keyframe_")
    if table:
        return keyframes.KEYFRAMES[feed][table](spark.createDataFrame([], DOCS)).schema
    shape = feeds.FEEDS[name]
    if shape.flatten_docs is None:
        return shape.flatten(spark.createDataFrame([], RAW)).schema
    return shape.flatten_docs(spark.createDataFrame([], RAW.replace("entry_no int, ", "").replace("payload", "doc"))).schema


def feed_table(
    spark: SparkSession, out: str, name: str, years: Sequence[int] | None = None, sessions: Sequence[str] | None = None
) -> DataFrame:
    """A written table, of some years or sessions only, whose folders alone are then read."""
    schema = table_schema(spark, name)
    rows = archive.read_written(spark, out, name, schema)
    if years is not None:
        rows = rows.filter(F.col("year").isin(list(years)))
    if sessions is not None:
        rows = rows.filter(F.col("session").isin(list(sessions)))
    return rows.select(*schema.names)


def feed_report(spark: SparkSession, out: str, names: Sequence[str]) -> DataFrame:
    """``feed, sessions, rows, status``: how much each table holds; a feed without files is ``absent``."""
    def counted(name: str) -> DataFrame:
        rows = archive.read_written(spark, out, name, table_schema(spark, name))
        return rows.agg(F.count_distinct("session").alias("sessions"), F.count("*").alias("rows")).select(F.lit(name).alias("feed"), "sessions", "rows")

    found = reduce(DataFrame.unionByName, map(counted, names))
    return found.withColumn("status", F.when(F.col("rows") == 0, "absent").otherwise("written"))


def lay_out_by_car(spark: SparkSession, out: str, buckets: int, names: Sequence[str] = ("CarData", "Position")) -> dict[str, str]:
    """Write tables of the archive's cars again, bucketed by session and car and sorted by clock. Returns the catalogue's names.

    Joins of such tables need no shuffle. Buckets hold whole cars of a session, so this suits sessions of ordinary length.
    """
    tables = {name: f"{name.lower()}_by_car" for name in names}
    for name, table in tables.items():
        rows = feed_table(spark, out, name).repartition(buckets, "session_id", "racing_number")
        laid = rows.write.mode("overwrite").option("path", f"{out.rstrip('/')}/{name}.by_car")
        laid.bucketBy(buckets, "session_id", "racing_number").sortBy("timestamp_ms").saveAsTable(table)
    return tables


def telemetry(
    spark: SparkSession, out: str, racing_number: int | None = None, years: Sequence[int] | None = None, by_car: dict[str, str] | None = None
) -> DataFrame:
    """Telemetry with the nearest position, from written tables; without a shuffle from those of :func:`lay_out_by_car`."""
    if by_car is None:
        return telemetry_on_track(*(feed_table(spark, out, name, years) for name in ("CarData", "Position")), racing_number)
    car, point = (spark.table(by_car[name]) for name in ("CarData", "Position"))
    if years is not None:
        car, point = (t.filter(F.split_part("session_id", F.lit("/"), F.lit(1)).cast("int").isin(list(years))) for t in (car, point))
    return telemetry_on_track(car, point, racing_number, ranges=0)


def catalogue(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Meetings and sessions of every season in the archive."""
    docs = archive.decode_documents(archive.read_documents(spark, [f"{root.rstrip('/')}/*/Index.json"]))
    return index.meetings(docs), index.sessions(docs)


def lookup(spark: SparkSession, root: str, out: str, feed: str, queries: DataFrame) -> DataFrame:
    """Rows of a written feed for ``query_id, year, meeting, session`` texts, with a status per query."""
    return catalog.feed_lookup(queries, *catalogue(spark, root), feed_table(spark, out, feed))


def race_control_by_session(spark: SparkSession, root: str, out: str) -> DataFrame:
    """Race control messages per session with the season's mean, over every session of the catalogue."""
    _, sessions = catalogue(spark, root)
    places = sessions.filter("path IS NOT NULL").select("year", F.rtrim("path", F.lit("/")).alias("session_id"))
    return catalog.messages_per_session(feed_table(spark, out, "RaceControlMessages"), places)
