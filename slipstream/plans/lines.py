"""Feed lines and keyframe documents written from the driver tables.

Every event becomes one line of a feed, whose payload is spelled as JSON in SQL; a day is a session. The
queries then decode and flatten these lines exactly as they would a mirrored archive.
"""

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.sources import archive

EVENT_COLUMNS = [
    "date_format(ts, 'yyyy-MM-dd') AS session_id",
    "event_id AS line_no",
    "date_format(ts, 'HH:mm:ss.SSS') AS clock",
    "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS utc6",
    "event_type AS et",
    "value AS v",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "CAST(user_id % 20 + 1 AS INT) AS car",
]

# The same reading of the table for the check SQL.
EVENTS_SQL = """e AS (
  SELECT strftime(ts, '%Y-%m-%d') AS session_id, event_id AS line_no, (epoch_us(ts) // 1000) % 86400000 AS timestamp_ms,
         ts, date_trunc('millisecond', ts) AS ts_ms, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS utc6,
         event_type AS et, value AS v, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id % 20 + 1 AS INTEGER) AS car
  FROM events)"""


def template(text: str) -> str:
    """SQL that builds ``text``, with each ``${expression}`` replaced by its value."""
    parts = re.split(r"\$\{([^}]*)\}", text)
    pieces = [f"'{p}'" if i % 2 == 0 else f"CAST(({p}) AS STRING)" for i, p in enumerate(parts)]
    return "concat(" + ", ".join(p for p in pieces if p != "''") + ")"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dealt out by their number over all shuffle partitions: the file itself may be a single split, unlike the many
    files of an archive that the lines stand for."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "event_type", "value", "props", "user_id")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id").selectExpr(*EVENT_COLUMNS)


def _spelled(text: str | Column) -> Column:
    """The text as a row of its own, so that filters on it are not copied below its spelling."""
    return F.explode(F.array(F.expr(text) if isinstance(text, str) else text)).alias("value")


def stream_lines(spark: SparkSession, sf_dir: str, payload: str, clock: str = "clock") -> DataFrame:
    """Text lines of a feed; ``payload`` and ``clock`` are SQL over the event columns."""
    return events(spark, sf_dir).select(
        "session_id", F.lit(0).cast("bigint").alias("block_no"), "line_no", _spelled(f"concat({clock}, {payload})")
    )


def entries(spark: SparkSession, sf_dir: str, payload: str, clock: str = "clock", judge: bool = True) -> DataFrame:
    return archive.decode_lines(stream_lines(spark, sf_dir, payload, clock), judge=judge)


def deflate_raw(text: Column) -> Column:
    """Raw deflate, to write compressed lines."""

    def deflate(texts: pa.Array) -> pa.Array:
        def one(t: str | None) -> bytes | None:
            if t is None:
                return None
            packer = zlib.compressobj(wbits=-zlib.MAX_WBITS)
            return packer.compress(t.encode("utf-8")) + packer.flush()

        return pa.array([one(t) for t in texts.to_pylist()], pa.binary())

    return F.arrow_udf(deflate, T.BinaryType())(text)


def compressed_lines(spark: SparkSession, sf_dir: str, document: str) -> DataFrame:
    """Compressed lines; ``document`` is SQL for the text to deflate."""
    rows = events(spark, sf_dir).selectExpr("session_id", "line_no", "clock", f"{document} AS doc")
    blob = F.base64(deflate_raw(F.col("doc")))
    line = F.concat("clock", F.lit('"'), blob, F.lit('"\r'))
    return rows.select("session_id", F.lit(0).cast("bigint").alias("block_no"), "line_no", _spelled(line))


def car_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each car and day: about 20 rows per session, however many events there are."""
    rows = events(spark, sf_dir)
    rest = F.struct("line_no", "clock", "utc6", "et", "v", "k")
    return rows.groupBy("session_id", "car").agg(F.max_by(rest, "line_no").alias("r")).select("session_id", "car", "r.*")


STATES_SQL = EVENTS_SQL + """,
st AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY session_id, car ORDER BY line_no DESC) = 1),
si AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY car) - 1 AS pos FROM st)"""


def car_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event: the n-th of each car and day goes to the session of the day's n-th round, at most 20 rows each."""
    order = Window.partitionBy("session_id", "car").orderBy("line_no")
    rows = events(spark, sf_dir).withColumn("round", F.row_number().over(order))
    return rows.withColumn("session_id", F.concat_ws("/", "session_id", "round")).drop("round")


ROUNDS_SQL = EVENTS_SQL + """,
st AS (SELECT * EXCLUDE (n) REPLACE (session_id || '/' || n AS session_id)
       FROM (SELECT *, row_number() OVER (PARTITION BY session_id, car ORDER BY line_no) AS n FROM e)),
si AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY car) - 1 AS pos FROM st)"""


def car_documents(spark: SparkSession, sf_dir: str, child: str, before: str, after: str, every: bool = False) -> DataFrame:
    """One document per session: a piece of JSON per car, in car order, between ``before`` and ``after``.

    Pieces are of the day's latest states, or with ``every`` of all events, a document per round.
    """
    states = car_rounds(spark, sf_dir) if every else car_states(spark, sf_dir)
    pieces = states.selectExpr("session_id", "car", f"{child} AS piece")
    gathered = F.transform(F.sort_array(F.collect_list(F.struct("car", "piece"))), lambda s: s["piece"])
    docs = pieces.groupBy("session_id").agg(F.concat_ws(",", gathered).alias("body"))
    return docs.select("session_id", F.concat(F.lit("\ufeff" + before), "body", F.lit(after)).alias("doc"))


def session_documents(spark: SparkSession, sf_dir: str, document: str) -> DataFrame:
    """One document per session, from the day's latest event."""
    rows = events(spark, sf_dir)
    rest = F.struct("line_no", "clock", "utc6", "et", "v", "k", "car")
    latest = rows.groupBy("session_id").agg(F.max_by(rest, "line_no").alias("r")).select("session_id", "r.*")
    return latest.selectExpr("session_id", f"{document} AS doc")


LATEST_SQL = EVENTS_SQL + """,
last AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY line_no DESC) = 1)"""
