"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. Each query runs once to warm up
and then ``BENCH_RUNS`` times; the median counts. Results are written to Spark's noop sink.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from slipstream.plans.registry import QUERIES  # noqa: E402
from slipstream.session import local_session  # noqa: E402

HEADLINE = [
    "raw_entries",
    "raw_entries_z",
    "car_data",
    "car_data_z",
    "position",
    "timing_segments",
    "timing_stats",
    "stints_app",
    "pit_stop_fill",
    "pit_lane_patch",
    "race_info_last",
    "rcm",
    "session_data",
    "weather_series",
    "lap_totals",
    "asof_nearest",
    "asof_backward",
    "kf_timing_lines",
    "meeting_search",
    "rows_with_session",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    times: dict[str, float] = {}
    for name in HEADLINE:
        samples = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        times[name] = round(statistics.median(samples[1:]), 3)
    total = round(sum(times.values()), 3)
    line = {"metric": "total_wall_clock", "value": total, "unit": "sec", "queries": times, "sf": Path(sf_dir).name.removeprefix("sf")}
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
