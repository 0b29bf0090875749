"""Scans of a mirrored archive: ``<root>/<year>/<meeting>/<session>/<file>``.

Stream files are read line by line and may be split over many tasks, so a very long file is no single
task's burden. ``block_no`` is the byte offset of a line's split and ``line_no`` orders the lines of a split; where the
file's own line numbers are wanted, they cost a counting scan. Keyframes are one document per file and are read whole. Files that a session
does not have give no rows.

Decoding is strict: a line or document that cannot be read ends the job, whatever columns are asked for, or with
``on_bad="drop"`` is passed over. :func:`line_faults` and :func:`document_faults` list what is wrong and where.
"""

import zlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.functions import parse
from slipstream.functions.jsonwalk import ENTRY, UNJUDGED, broken_json, judged, once, parsed

BOM = "\ufeff"
BLANKS = "\r\n\t "
#: What may be wrong with a line.
FAULTS = ["mark", "clock", "blob", "json"]


def inflate_raw(blob: Column) -> Column:
    """Raw deflate to text, batch by batch; null where a blob cannot be read. Spark has no built-in for it.

    The function is nested so that it travels by value and workers need no copy of this package.
    """

    def inflate(blobs: pa.Array) -> pa.Array:
        def one(blob: bytes | None) -> str | None:
            try:
                return None if blob is None else zlib.decompress(blob, -zlib.MAX_WBITS).decode("utf-8")
            except (zlib.error, UnicodeDecodeError):
                return None

        return pa.array([one(b) for b in blobs.to_pylist()], pa.string())

    return F.arrow_udf(inflate, T.StringType())(blob)


def session_of(path: Column) -> Column:
    """``year/meeting/session`` of a file path."""
    text = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(text, r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1)


def feed_paths(root: str, file: str, sessions: Sequence[str] = ("*/*/*",)) -> list[str]:
    """Paths of one file over sessions; the default takes every session of every year."""
    return [f"{root.rstrip('/')}/{s.strip('/')}/{file}" for s in sessions]


def _texts(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame | None:
    """Text of files of one name, read through their folders so that absent files are no error; None without any folder."""
    folders, names = zip(*[(folder, name) for folder, _, name in (p.rpartition("/") for p in paths)], strict=True)
    if len(set(names)) != 1:
        raise ValueError(f"files of different names in one scan: {sorted(set(names))}")
    top = folders[0] if len(folders) == 1 else commonpath_of(folders)
    rest = [f[len(top) :].strip("/") for f in folders]
    wanted = top if len(folders) == 1 else f"{top}/{{{','.join(rest)}}}"
    try:
        return spark.read.options(pathGlobFilter=names[0], **options).text(wanted)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commonpath_of(folders: Sequence[str]) -> str:
    """The longest folder that all of ``folders`` are in."""
    parts = [f.split("/")[:-1] for f in folders]
    same = [p[0] for p in zip(*parts, strict=False) if len(set(p)) == 1]
    return "/".join(same)


def read_stream_lines(spark: SparkSession, paths: Sequence[str], numbered: bool = False) -> DataFrame:
    """``session_id, block_no, line_no, value`` for the lines of all files in one scan.

    ``(block_no, line_no)`` is the order of a file's lines: ``block_no`` is the byte offset of the split, ``line_no`` counts
    the rows of the task that reads the split, so neither needs another look at the text. With ``numbered`` the lines of
    all splits are counted first, in a scan of its own, and ``line_no`` is the line's number in its file.
    """
    found = _texts(spark, paths, lineSep="\n")
    if found is None:
        return spark.createDataFrame([], "session_id string, block_no long, line_no long, value string")
    path, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start").alias("block_no")
    row = F.monotonically_increasing_id()
    if not numbered:
        return found.select(session_of(path).alias("session_id"), block, row.alias("line_no"), "value")
    rows = found.select(session_of(path).alias("session_id"), F.xxhash64(path).alias("_file"), block, row.alias("_row"), "value")
    joined = rows.join(split_index(found), ["_file", "block_no"])
    return joined.select("session_id", "block_no", (F.col("_row") - F.col("first_row") + F.col("before")).alias("line_no"), "value")


def split_index(texts: DataFrame) -> DataFrame:
    """``_file, block_no, first_row, lines, before`` of each split of a text scan: its first row, its lines, and those of the
    file's splits before it. One row per split; it holds for a scan that is split alike."""
    row = F.monotonically_increasing_id()
    splits = texts.select(F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("block_no"), row.alias("_row"))
    sums = splits.groupBy("_file", "block_no").agg(F.min("_row").alias("first_row"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("_file").orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("before", F.coalesce(F.sum("lines").over(earlier), F.lit(0)))


def _split_clock(lines: DataFrame, mark: str) -> DataFrame:
    """Clock before the first ``mark`` and the text from there on; blank lines go."""
    value = F.col("value")
    at = F.instr(value, mark)
    filled = (at > 0) | (F.trim(value, F.lit(BOM + BLANKS)) != "")
    halves = lines.filter(filled).select(
        "*",
        F.when(at > 0, F.trim(F.substring(value, F.lit(1), at - 1), F.lit(BOM + BLANKS))).alias("lead"),
        F.when(at > 0, F.substring(value, at, F.length(value))).alias("rest"),
    )
    return halves.withColumn("timestamp_ms", parse.clock_ms(F.col("lead"))).drop("lead")


def _opened_lines(lines: DataFrame, compressed: bool) -> DataFrame:
    """Lines with ``doc``, the payload or inflated text, and ``fault``: mark, clock, blob, or null; JSON is not judged."""
    rows = _split_clock(lines, '"' if compressed else "{")
    rest = F.col("rest")
    if compressed:
        rows = rows.select("*", once(inflate_raw(F.try_to_binary(F.trim(rest, F.lit('"' + BLANKS)), F.lit("base64")))).alias("doc"))
    else:
        rows = rows.withColumn("doc", F.when(F.endswith(rest, F.lit("\r")), F.left(rest, F.length(rest) - 1)).otherwise(rest))
    fault = F.when(rest.isNull(), "mark").when(F.col("timestamp_ms").isNull(), "clock").when(F.col("doc").isNull(), "blob")
    return rows.withColumn("fault", fault).drop("rest")


def judged_lines(lines: DataFrame, compressed: bool) -> DataFrame:
    """Lines with ``doc``, the payload or inflated text, and ``fault``: mark, clock, blob, json, or null if it is sound."""
    json = F.when(broken_json(F.col("doc")), "json")
    return _opened_lines(lines, compressed).withColumn("fault", F.coalesce("fault", json))


def line_faults(lines: DataFrame, compressed: bool = False) -> DataFrame:
    """The lines a strict decode would stop at, with ``fault``: no payload ``mark``, ``clock``, ``blob`` or ``json``.

    Lines that were read ``numbered`` are named by their number in the file.
    """
    return judged_lines(lines, compressed).filter("fault IS NOT NULL").select("session_id", "block_no", "line_no", "value", "fault")


def bad_lines(lines: DataFrame, compressed: bool = False) -> DataFrame:
    """The lines a strict decode would stop at."""
    return line_faults(lines, compressed).drop("fault")


def _sound(rows: DataFrame, on_bad: str, what: str, text: str) -> DataFrame:
    """Rows without a fault. The refusal is a filter, so no choice of columns takes it away."""
    if on_bad not in ("raise", "drop"):
        raise ValueError(f"on_bad is raise or drop, not {on_bad!r}")
    if on_bad == "drop":
        return rows.filter("fault IS NULL").drop("fault")
    complaint = F.raise_error(F.concat(F.lit(f"Malformed {what} ("), F.col("fault"), F.lit("): "), F.substring(text, 1, 80)))
    return rows.filter(F.when(F.col("fault").isNotNull(), complaint.cast("boolean")).otherwise(F.lit(True))).drop("fault")


def inflate_lines(lines: DataFrame, on_bad: str = "raise", judge: bool = True) -> DataFrame:
    """Compressed lines to ``session_id, block_no, line_no, timestamp_ms, doc``, one JSON text per line.

    With ``judge=False`` the text's JSON is judged by the parse that reads it, which is cheaper.
    """
    rows = _sound(_opened_lines(lines, compressed=True), on_bad, "stream line", "value").withColumn(UNJUDGED, F.lit(on_bad))
    rows = rows.select(*ENTRY[:3], "timestamp_ms", "doc", UNJUDGED)
    return judged(rows, "doc") if judge else rows


def decode_lines(lines: DataFrame, compressed: bool = False, on_bad: str = "raise", judge: bool = True) -> DataFrame:
    """Text lines to raw entries: ``session_id, block_no, line_no, entry_no, timestamp_ms, payload``.

    ``on_bad`` is ``raise`` or ``drop``; :func:`bad_lines` shows what is dropped. With ``judge=False`` the functions of
    ``operators.feeds`` judge the JSON of a payload by the parse that reads it; such entries have one column more.
    """
    if not compressed:
        rows = _sound(_opened_lines(lines, compressed=False), on_bad, "stream line", "value").withColumn(UNJUDGED, F.lit(on_bad))
        rows = rows.select(*ENTRY[:3], F.lit(0).alias("entry_no"), "timestamp_ms", F.col("doc").alias("payload"), UNJUDGED)
        return judged(rows) if judge else rows
    docs = parsed(inflate_lines(lines, on_bad, judge=False), "Entries ARRAY<STRING>, Position ARRAY<STRING>", "doc", "_d")
    return _entries(docs)


def entries_of_documents(docs: DataFrame) -> DataFrame:
    """Inflated documents to raw entries."""
    return _entries(parsed(docs, "Entries ARRAY<STRING>, Position ARRAY<STRING>", "doc", "_d"))


def _entries(docs: DataFrame) -> DataFrame:
    items = F.posexplode(F.coalesce("_d.Entries", "_d.Position")).alias("entry_no", "payload")
    return docs.select(*ENTRY[:3], "timestamp_ms", items).select(*ENTRY, "payload")


def read_entries(
    spark: SparkSession, root: str, file: str, sessions: Sequence[str] = ("*/*/*",), on_bad: str = "raise", judge: bool = True, numbered: bool = False
) -> DataFrame:
    """Raw entries of one feed over many sessions in one scan."""
    lines = read_stream_lines(spark, feed_paths(root, file, sessions), numbered)
    return decode_lines(lines, compressed=".z." in file, on_bad=on_bad, judge=judge)


def read_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``session_id, doc`` for keyframe files, one document per file."""
    docs = _texts(spark, paths, wholetext="true")
    if docs is None:
        return spark.createDataFrame([], "session_id string, doc string")
    return docs.select(session_of(F.col("_metadata.file_path")).alias("session_id"), F.col("value").alias("doc"))


def _judged_documents(docs: DataFrame, compressed: bool) -> DataFrame:
    text = F.trim("doc", F.lit(BOM + BLANKS))
    if compressed:
        rows = docs.select("*", once(inflate_raw(F.try_to_binary(F.trim(text, F.lit('"')), F.lit("base64")))).alias("_text"))
    else:
        rows = docs.withColumn("_text", text)
    fault = F.when(F.col("_text").isNull(), "blob").when(broken_json(F.col("_text")), "json")
    return rows.withColumn("fault", fault)


def document_faults(docs: DataFrame, compressed: bool = False) -> DataFrame:
    """``session_id, fault`` of the documents a strict decode would stop at: a ``blob`` or ``json`` that cannot be read."""
    return _judged_documents(docs, compressed).filter("fault IS NOT NULL").select("session_id", "fault")


def decode_documents(docs: DataFrame, compressed: bool = False, on_bad: str = "raise") -> DataFrame:
    """Strip the byte-order mark, undo the compression, and open a one-element list."""
    rows = _sound(_judged_documents(docs, compressed), on_bad, "document", "doc")
    opened = F.get(F.from_json("_text", "ARRAY<STRING>"), F.lit(0))
    return rows.withColumn("doc", F.when(F.startswith("_text", F.lit("[")), opened).otherwise(F.col("_text"))).drop("_text")


def read_keyframes(
    spark: SparkSession, root: str, file: str, sessions: Sequence[str] = ("*/*/*",), on_bad: str = "raise"
) -> DataFrame:
    return decode_documents(read_documents(spark, feed_paths(root, file, sessions)), compressed=".z." in file, on_bad=on_bad)


FILES = "session_id string, path string, length long, modified timestamp"


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``session_id, path, length, modified`` of files of one name; nothing in them is read. Absent files give no rows."""
    folders, names = zip(*[(folder, name) for folder, _, name in (p.rpartition("/") for p in paths)], strict=True)
    if len(set(names)) != 1:
        raise ValueError(f"files of different names in one listing: {sorted(set(names))}")
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", names[0]).load(list(folders))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES)
    return found.select(session_of(F.col("path")).alias("session_id"), "path", "length", F.col("modificationTime").alias("modified"))


def write_feed(table: DataFrame, out: str, feed: str, mode: str = "overwrite", replaced: Sequence[str] = ()) -> str:
    """Write a feed table as Parquet, split by year and session, for jobs that span sessions. Returns the folder.

    Sessions that are not in ``table`` keep what was written before, but for those ``replaced``, which then have no rows. Rows are gathered by session before they are
    written; a busy session is split over several tasks and files.
    """
    target = f"{out.rstrip('/')}/{feed}"
    year = F.split_part("session_id", F.lit("/"), F.lit(1))
    rows = table.withColumns({"year": year, "session": F.col("session_id")}).hint("rebalance", "session")
    if replaced:
        _empty_sessions(table.sparkSession, target, replaced)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("year", "session").parquet(target)
    return target


def _empty_sessions(spark: SparkSession, target: str, sessions: Sequence[str]) -> None:
    """Overwrite what was written of sessions with no rows."""
    old = read_written(spark, target.rpartition("/")[0], target.rpartition("/")[2], T.StructType())
    there = [r[0] for r in old.filter(F.col("session").isin(list(sessions))).select("session").distinct().collect()]
    jvm = spark._jvm
    for session in there:
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(session)
        folder = jvm.org.apache.hadoop.fs.Path(f"{target}/year={session.split('/')[0]}/session={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_written(spark: SparkSession, out: str, feed: str, schema: T.StructType) -> DataFrame:
    """What :func:`write_feed` wrote, with ``year`` and ``session`` as partitions; no rows if nothing was written."""
    full = T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("session", T.StringType())])
    try:
        return spark.read.schema(full).parquet(f"{out.rstrip('/')}/{feed}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
