"""A small archive end to end: files to tables to joins, and what of it reaches the scan."""

import json

import pytest
from tests.test_archive import packed, put

from slipstream.operators import quality
from slipstream.plans import season_job
from slipstream.sources import archive


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    sessions = ["2023/m1/s1", "2024/m2/s2"]
    for n, session in enumerate(sessions):
        cars, points = [], []
        for i in range(20):
            cars.append(f'00:00:{i:02d}.000"{packed({"Entries": [{"Utc": "2024-01-01T00:00:00Z", "Cars": {"44": {"Channels": {"2": i}}, "7": {"Channels": {"2": 2 * i}}}}]})}"')
            points.append(f'00:00:{i:02d}.400"{packed({"Position": [{"Timestamp": "t", "Entries": {"44": {"X": i}}}]})}"')
        put(root, session, "CarData.z.jsonStream", "\r\n".join(cars))
        put(root, session, "Position.z.jsonStream", "\r\n".join(points))
        put(root, session, "RaceControlMessages.jsonStream", "\n".join(f'00:00:0{i}.000{{"Messages":{{"{i}":{{"Message":"m"}}}}}}' for i in range(n + 1)))
        year = session[:4]
        listed = [{"Key": 1, "Name": "Race", "StartDate": f"{year}-01-01T00:00:00", "GmtOffset": "00:00:00", "Path": session + "/"}]
        put(root, year, "Index.json", json.dumps({"Year": int(year), "Meetings": [{"Key": 1, "Number": 1, "Name": "Some Grand Prix", "Location": "L", "Sessions": listed}]}))
    out = str(tmp_path_factory.mktemp("tables"))
    season_job.build_feed_tables(spark, str(root), out, ["CarData", "Position", "RaceControlMessages"])
    return str(root), out


def test_telemetry(spark, built):
    rows = season_job.telemetry(spark, built[1], racing_number=44).collect()
    assert sorted((r.session_id, r.timestamp_s, r.speed, r.x) for r in rows) == sorted(
        (s, i, i, float(max(i, 0) if i == 0 else i)) for s in ("2023/m1/s1", "2024/m2/s2") for i in range(20)
    )
    alone = season_job.telemetry(spark, built[1], racing_number=7).collect()
    assert {r.x for r in alone} == {None}


def test_car_filter_reaches_both_scans(spark, built):
    plan = season_job.telemetry(spark, built[1], racing_number=44)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans
    assert all("EqualTo(racing_number,44)" in line for line in scans)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_messages(spark, built):
    rows = season_job.race_control_by_session(spark, *built).collect()
    assert sorted((r.year, r.session_id, r.messages) for r in rows) == [(2023, "2023/m1/s1", 1), (2024, "2024/m2/s2", 2)]


def test_two_builds_in_a_row_keep_both(spark, tmp_path):
    root, out = tmp_path / "archive", str(tmp_path / "tables")
    for n, session in enumerate(["2024/m/s1", "2024/m/s2"]):
        put(root, session, "TrackStatus.jsonStream", f'00:00:01.000{{"Status":"{n}","Message":"x"}}\n')
        season_job.build_feed_tables(spark, str(root), out, ["TrackStatus"], [session])
    season_job.build_feed_tables(spark, str(root), out, ["TrackStatus"], ["2024/m/s2"])
    rows = season_job.feed_table(spark, out, "TrackStatus").collect()
    assert sorted((r.session_id, r.status) for r in rows) == [("2024/m/s1", 0), ("2024/m/s2", 1)]


def test_an_archive_with_few_feeds(spark, tmp_path):
    root, out = tmp_path / "archive", str(tmp_path / "tables")
    put(root, "2024/m/s1", "TrackStatus.jsonStream", '00:00:01.000{"Status":"1","Message":"x"}\n')
    put(root, "2024/m/s1", "LapCount.jsonStream", '00:00:01.000{"CurrentLap":3,"TotalLaps":60}\n')
    put(root, "2024/m/s1", "TrackStatus.json", '{"Status":"2","Message":"y"}')
    names = ["TrackStatus", "PitStop", "CarData", "LapCount"]
    season_job.build_feed_tables(spark, str(root), out, names)
    season_job.build_derived_tables(spark, str(root), out)
    written = season_job.build_keyframe_tables(spark, str(root), out, ["TrackStatus", "TimingStats"])
    assert set(written) == {"TrackStatus.keyframe_status", "TimingStats.keyframe_lines", "TimingStats.keyframe_sectors"}
    report = season_job.feed_report(spark, out, [*names, "LapCount.lap_totals", "DriverRaceInfo.starting_grid", *written]).collect()
    assert {r.feed: (r.sessions, r.rows, r.status) for r in report} == {
        "TrackStatus": (1, 1, "written"), "PitStop": (0, 0, "absent"), "CarData": (0, 0, "absent"), "LapCount": (1, 1, "written"),
        "LapCount.lap_totals": (1, 1, "written"), "DriverRaceInfo.starting_grid": (0, 0, "absent"),
        "TrackStatus.keyframe_status": (1, 1, "written"), "TimingStats.keyframe_lines": (0, 0, "absent"), "TimingStats.keyframe_sectors": (0, 0, "absent"),
    }
    assert season_job.telemetry(spark, out).count() == 0


def test_years_prune_folders(spark, built):
    plan = season_job.telemetry(spark, built[1], years=[2024])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("PartitionFilters: [isnotnull(year" in line or "year#" in line.split("PartitionFilters")[1] for line in scans)
    assert {r.session_id for r in season_job.telemetry(spark, built[1], years=[2024]).collect()} == {"2024/m2/s2"}


def test_from_names_to_rows(spark, built):
    asked = [("a", 2024, "grand", "race"), ("b", 2024, "nowhere", "race"), ("c", 2023, "grand", "sprint")]
    queries = spark.createDataFrame(asked, "query_id string, year int, meeting string, session string")
    found = season_job.lookup(spark, *built, "RaceControlMessages", queries).collect()
    assert sorted((r.query_id, r.lookup_status, r.session_id, r.message) for r in found if r.query_id != "a") == [
        ("b", "no meeting", None, None), ("c", "no session", None, None),
    ]
    assert [(r.lookup_status, r.session_id, r.message) for r in found if r.query_id == "a"] == [("found", "2024/m2/s2", "m")] * 2


def _status(root, session, text):
    folder = root / session
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "TrackStatus.jsonStream").write_text(text)


def test_update_reads_only_new_and_changed_files(spark, tmp_path):
    root, out = tmp_path / "archive", str(tmp_path / "out")
    line = '00:00:0{}.000{{"Status":"{}","Message":"m"}}\n'.format
    update = lambda: season_job.update_feed_tables(spark, str(root), out, ["TrackStatus", "PitStop"])
    rows = lambda: sorted((r.session_id, r.status) for r in season_job.feed_table(spark, out, "TrackStatus").collect())
    _status(root, "2024/São_Paulo+1/b", line(1, 1))
    _status(root, "2024/a/c", line(1, 2) + line(2, 3))
    assert update() == {"TrackStatus": 2, "PitStop": 0}
    assert rows() == [("2024/São_Paulo+1/b", 1), ("2024/a/c", 2), ("2024/a/c", 3)]
    assert update() == {"TrackStatus": 0, "PitStop": 0}
    _status(root, "2024/a/d", line(1, 4))
    _status(root, "2024/a/c", "\n")  # no rows any more
    (root / "2024/São_Paulo+1/b/TrackStatus.jsonStream").chmod(0o000)  # an old file is not opened again
    changed = season_job.changed_files(spark, str(root), out, "TrackStatus")
    assert sorted(r.session_id for r in changed.collect()) == ["2024/a/c", "2024/a/d"]
    assert update() == {"TrackStatus": 2, "PitStop": 0}
    assert rows() == [("2024/São_Paulo+1/b", 1), ("2024/a/d", 4)]
    assert sorted((r.session_id, r.rows) for r in season_job.manifest(spark, out, "TrackStatus").collect()) == [("2024/São_Paulo+1/b", 1), ("2024/a/c", 0), ("2024/a/d", 1)]
    with pytest.raises(Exception, match="Malformed"):
        _status(root, "2024/a/e", "no line\n")
        update()
    _status(root, "2024/a/e", line(1, 5))
    assert update()["TrackStatus"] == 1 and ("2024/a/e", 5) in rows()


def test_a_write_reports_what_it_has_seen(spark, tmp_path):
    text = '00:00:01.000{"Status":"1","Message":"m"}\n00:00:02.000{"Status":"x","Message":"m"}\nnone\n00:00:03.000{"Status":\n{"Status":"2"}\n'
    root = tmp_path / "archive"
    _status(root, "2024/a/b", text)
    _status(root, "2024/a/c", text)
    types, out = {"Status": "smallint", "Message": "string"}, str(tmp_path / "out")
    got = season_job.write_with_report(spark, str(root), out, "TrackStatus", types=types)
    lines = archive.read_stream_lines(spark, archive.feed_paths(str(root), "TrackStatus.jsonStream"))
    raw = archive.decode_lines(lines, on_bad="drop")
    want = {"lines": lines.count()}
    for report in (quality.line_report(lines), quality.type_report(raw, types)):
        want |= {r.rule: r.n for r in report.groupBy("rule").sum("breaches").toDF("rule", "n").collect()}
    assert got == want and got["Status"] == 2 and got["json"] == 2
    assert season_job.feed_table(spark, out, "TrackStatus").count() == 4


def test_tables_by_car_are_joined_without_a_shuffle(spark, built):
    out = built[1]
    by_car = season_job.lay_out_by_car(spark, out, 4)
    try:
        joined = season_job.telemetry(spark, out, by_car=by_car)
        want = season_job.telemetry(spark, out)
        assert joined.columns == want.columns
        assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange" not in plan and "Join" not in plan
        assert season_job.telemetry(spark, out, years=[2024], by_car=by_car).count() == season_job.telemetry(spark, out, years=[2024]).count() > 0
    finally:
        for table in by_car.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
