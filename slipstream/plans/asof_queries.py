"""As-of joins: every event is telemetry or position of a car, by its type."""

from pyspark.sql import DataFrame, SparkSession

from slipstream.operators import feeds
from slipstream.operators.asof import asof_join, telemetry_on_track
from slipstream.plans.feed_queries import Query
from slipstream.plans.lines import EVENTS_SQL, entries, template

CAR = template('{"Utc":"${utc6}7Z","Cars":{"${car}":{"Channels":{"0":${k * 100},"2":${k},"3":${k % 9},"4":${v},"5":0}}}}')
POINT = template('{"Timestamp":"${utc6}Z","Entries":{"${car}":{"Status":"OnTrack","X":${k * 10},"Y":${v},"Z":${-k}}}}')
IS_CAR = "et IN ('view', 'error', 'signup')"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Telemetry and position; a line of the other feed has no cars for this one."""
    car = feeds.car_data(entries(spark, sf_dir, f"CASE WHEN {IS_CAR} THEN {CAR} ELSE '{{}}' END", judge=False))
    point = feeds.position(entries(spark, sf_dir, f"CASE WHEN {IS_CAR} THEN '{{}}' ELSE {POINT} END", judge=False))
    return car, point


def _joined(strategy: str, tolerance: int | None = None, ranges: int | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        car, point = _sides(spark, sf_dir)
        rows = asof_join(car, point, strategy=strategy, tolerance=tolerance, ranges=ranges)
        return rows.drop("block_no", "entry_no", "key_pos")

    return run


# Positions per key and clock (the later line counts) and, per telemetry row, the positions on both sides.
SIDES_SQL = f"""WITH {EVENTS_SQL},
l AS (SELECT session_id, line_no, timestamp_ms, ts AS utc, car::SMALLINT AS racing_number, k * 100 AS rpm, k AS speed,
        (k % 9)::SMALLINT AS gear, v AS throttle, 0::SMALLINT AS brake, NULL::SMALLINT AS drs FROM e WHERE {IS_CAR}),
r AS (SELECT session_id, car::SMALLINT AS racing_number, timestamp_ms AS at, utc6 || 'Z' AS utc_right, 'OnTrack' AS status,
        (k * 10)::DOUBLE AS x, v AS y, (-k)::DOUBLE AS z FROM e WHERE NOT ({IS_CAR})
      QUALIFY row_number() OVER (PARTITION BY session_id, car, timestamp_ms ORDER BY line_no DESC) = 1),
b AS (SELECT l.line_no, r.at AS before_at FROM l ASOF JOIN r ON l.session_id = r.session_id
        AND l.racing_number = r.racing_number AND l.timestamp_ms >= r.at),
a AS (SELECT l.line_no, r.at AS after_at FROM l ASOF JOIN r ON l.session_id = r.session_id
        AND l.racing_number = r.racing_number AND l.timestamp_ms <= r.at),
m AS (SELECT l.*, before_at, after_at FROM l LEFT JOIN b USING (line_no) LEFT JOIN a USING (line_no))"""
NEAREST = """CASE WHEN after_at IS NULL OR timestamp_ms - before_at <= after_at - timestamp_ms THEN before_at
             ELSE after_at END"""


def _sql(chosen: str, more: str = "", where: str = "") -> str:
    return f"""{SIDES_SQL}
      SELECT m.* EXCLUDE (before_at, after_at), utc_right, status, x, y, z{more} FROM m LEFT JOIN r
      ON r.session_id = m.session_id AND r.racing_number = m.racing_number AND r.at = {chosen} {where}"""


QUERIES = {
    "asof_nearest": Query(_joined("nearest"), _sql(f"({NEAREST})")),
    "asof_backward": Query(_joined("backward"), _sql("before_at")),
    "asof_forward": Query(_joined("forward"), _sql("after_at")),
    "asof_tolerance": Query(
        _joined("nearest", tolerance=900_000),
        _sql(f"(CASE WHEN abs(({NEAREST}) - timestamp_ms) <= 900000 THEN ({NEAREST}) END)"),
    ),
    "asof_one_minute_buckets": Query(_joined("nearest", ranges=60), _sql(f"({NEAREST})")),
    "telemetry_on_track": Query(
        lambda spark, sf_dir: telemetry_on_track(*_sides(spark, sf_dir), racing_number=7).drop(
            "block_no", "entry_no", "key_pos"
        ),
        _sql(f"({NEAREST})", ", m.timestamp_ms // 1000 AS timestamp_s", "WHERE m.racing_number = 7"),
    ),
}
