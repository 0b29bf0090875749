"""Files of a mirrored archive, with the shapes real ones have and the ones a decode must refuse."""

import base64
import json
import zlib

import pytest
from pyspark.sql import DataFrame

from slipstream.operators import feeds, keyframes
from slipstream.sources import archive, index

BOM = "\ufeff"


def packed(value, pad=True):
    packer = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    text = base64.b64encode(packer.compress(json.dumps(value).encode()) + packer.flush()).decode()
    return text if pad else text.rstrip("=")


def put(root, session, file, text):
    folder = root / session
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_bytes(text.encode())


def entries(spark, root, file, **options):
    rows = archive.read_entries(spark, str(root), file, **options).orderBy("session_id", "block_no", "line_no", "entry_no")
    return [(r.session_id, r.timestamp_ms, r.entry_no, json.loads(r.payload)) for r in rows.collect()]


def test_stream_with_mark_crlf_and_blank_lines(spark, tmp_path):
    put(tmp_path, "2024/São_Paulo/Race", "X.jsonStream", BOM + '00:00:01.000{"a":1}\r\n\r\n00:00:02.500{"a":2}\r\n')
    put(tmp_path, "2024/Monza+1/Race", "X.jsonStream", '00:00:03.000{"a":{"b":[1]}}\n')
    assert entries(spark, tmp_path, "X.jsonStream") == [
        ("2024/Monza+1/Race", 3000, 0, {"a": {"b": [1]}}),
        ("2024/São_Paulo/Race", 1000, 0, {"a": 1}),
        ("2024/São_Paulo/Race", 2500, 0, {"a": 2}),
    ]
    one = entries(spark, tmp_path, "X.jsonStream", sessions=["2024/Monza+1/Race"])
    assert len(one) == 1


def test_malformed_lines_stop_or_drop(spark, tmp_path):
    put(tmp_path, "2024/a/b", "X.jsonStream", '00:00:01.000{"a":1}\n00:00:01.000 no json here\n{"no":"clock"}\n')
    with pytest.raises(Exception, match="Malformed stream line"):
        entries(spark, tmp_path, "X.jsonStream")
    assert len(entries(spark, tmp_path, "X.jsonStream", on_bad="drop")) == 1
    lines = archive.read_stream_lines(spark, archive.feed_paths(str(tmp_path), "X.jsonStream"))
    assert {r.value for r in archive.bad_lines(lines).collect()} == {"00:00:01.000 no json here", '{"no":"clock"}'}


@pytest.mark.parametrize("pad", [True, False])
def test_compressed_stream(spark, tmp_path, pad):
    first = packed({"Entries": [{"n": 1}, {"n": 2}]}, pad)
    second = packed({"Position": [{"n": 3}]}, pad)
    neither = packed({"Entries": 5}, pad)
    text = f'{BOM}00:00:01.000"{first}"\r\n\r\n00:00:02.000"{second}"\r\n00:00:03.000"{neither}"\r\n'
    put(tmp_path, "2024/a/b", "X.z.jsonStream", text)
    assert [(ms, no, p["n"]) for _, ms, no, p in entries(spark, tmp_path, "X.z.jsonStream")] == [
        (1000, 0, 1), (1000, 1, 2), (2000, 0, 3),
    ]


def test_compressed_line_without_quote(spark, tmp_path):
    put(tmp_path, "2024/a/b", "X.z.jsonStream", "00:00:01.000 no quote here\n")
    with pytest.raises(Exception, match="Malformed stream line"):
        entries(spark, tmp_path, "X.z.jsonStream")


def test_order_survives_splits(spark, tmp_path):
    text = "".join(f'00:{i // 60:02d}:{i % 60:02d}.000{{"n":{i}}}\r\n' for i in range(3000))
    put(tmp_path, "2024/a/b", "X.jsonStream", BOM + text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = archive.read_entries(spark, str(tmp_path), "X.jsonStream")
        assert rows.rdd.getNumPartitions() > 4
        got = entries(spark, tmp_path, "X.jsonStream")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [p["n"] for *_, p in got] == list(range(3000))


def test_keyframes_plain_listed_and_compressed(spark, tmp_path):
    put(tmp_path, "2024/a/b", "TrackStatus.json", BOM + '{"Status":"2","Message":"Yellow"}')
    put(tmp_path, "2024/a/c", "TrackStatus.json", '[{"Status":1,"Message":"AllClear"}]\n')
    rows = keyframes.track_status(archive.read_keyframes(spark, str(tmp_path), "TrackStatus.json")).orderBy("session_id")
    assert [tuple(r) for r in rows.collect()] == [("2024/a/b", 2, "Yellow"), ("2024/a/c", 1, "AllClear")]

    document = {"Entries": [{"Utc": "u", "Cars": {"44": {"Channels": {"0": 9000, "45": 8}}}}]}
    put(tmp_path, "2024/a/b", "CarData.z.json", BOM + '"' + packed(document) + '"')
    rows = keyframes.car_data(archive.read_keyframes(spark, str(tmp_path), "CarData.z.json"))
    assert [tuple(r) for r in rows.collect()] == [("2024/a/b", "u", "44", 9000, 0, 0, 0, 0, 8)]


def test_whole_documents_and_entries_agree(spark, tmp_path):
    """The shortcut from inflated documents gives what the raw entries give, odd shapes included."""
    snapshots = [
        {"Utc": "2024-01-01T00:00:00Z", "Cars": {"1": {"Channels": {"0": 1, "2": 2, "3": 3, "4": 4.5, "5": 0, "45": 8}}, "2": {}}},
        {"Utc": "2024-01-01T00:00:01Z", "Cars": {"1": {"Channels": {"0": "7", "45": None}}, "2": None, "3": "x", "4": {"Channels": [1]}}},
        {"Utc": 5, "Cars": [1, 2]},
    ]
    lines = [f'00:00:0{i}.000"{packed({"Entries": snapshots[: i + 1]})}"' for i in range(3)]
    put(tmp_path, "2024/a/b", "CarData.z.jsonStream", "\r\n".join(lines))
    read = archive.read_stream_lines(spark, archive.feed_paths(str(tmp_path), "CarData.z.jsonStream"))
    slow = feeds.car_data(archive.decode_lines(read, compressed=True)).drop("key_pos")
    fast = feeds.car_data_docs(archive.inflate_lines(read)).drop("key_pos")
    assert sorted(map(repr, slow.collect())) == sorted(map(repr, fast.collect()))
    assert slow.count() == 2 + 4 + 4


def test_feed_tables_as_parquet(spark, tmp_path):
    put(tmp_path, "2023/a/b", "TrackStatus.jsonStream", '00:00:01.000{"Status":"1","Message":"AllClear"}\n')
    put(tmp_path, "2024/a/b", "TrackStatus.jsonStream", '00:00:01.000{"Status":"2","Message":"Yellow"}\n')
    rows = feeds.read_feed(spark, str(tmp_path), "TrackStatus")
    target = archive.write_feed(rows, str(tmp_path / "tables"), "TrackStatus")
    back = spark.read.parquet(target).filter("year = 2024")
    assert [(r.session_id, r.status, r.message) for r in back.collect()] == [("2024/a/b", 2, "Yellow")]


@pytest.mark.parametrize(
    "line,fault",
    [('00:00:02.000{"44":{"Line":2},', "json"), ("00:00:02.000 none", "mark"), ('{"no":"clock"}', "clock"), ('00:00:02.000{"44" 1}', "json")],
)
def test_strict_whatever_is_asked_for(spark, tmp_path, line, fault):
    put(tmp_path, "2024/a/b", "DriverList.jsonStream", f'00:00:01.000{{"44":{{"Line":1}}}}\n{line}\n00:00:03.000{{"44":{{"Line":3}}}}\n')
    read = lambda **options: feeds.read_feed(spark, str(tmp_path), "DriverList", **options)
    for use in (DataFrame.count, lambda d: d.select("session_id", "timestamp_ms").collect(), DataFrame.collect):
        with pytest.raises(Exception, match="Malformed stream line"):
            use(read())
    assert read(on_bad="drop").count() == 2
    lines = archive.read_stream_lines(spark, archive.feed_paths(str(tmp_path), "DriverList.jsonStream"))
    assert [(r.line_no, r.value, r.fault) for r in archive.line_faults(lines).collect()] == [(1, line, fault)]


def test_cut_off_blobs_and_documents(spark, tmp_path):
    good = packed({"Entries": [{"n": 1}]})
    cut = packed({"Entries": [{"n": list(range(40))}]})[:32]
    put(tmp_path, "2024/a/b", "X.z.jsonStream", f'00:00:01.000"{good}"\n00:00:02.000"{cut}"\n00:00:03.000"***"\n00:00:04.000"{packed("x")}"\n')
    with pytest.raises(Exception, match="Malformed stream line .blob"):
        archive.read_entries(spark, str(tmp_path), "X.z.jsonStream").count()
    assert [no for _, _, no, _ in entries(spark, tmp_path, "X.z.jsonStream", on_bad="drop")] == [0]
    lines = archive.read_stream_lines(spark, archive.feed_paths(str(tmp_path), "X.z.jsonStream"))
    assert sorted((r.line_no, r.fault) for r in archive.line_faults(lines, compressed=True).collect()) == [(1, "blob"), (2, "blob"), (3, "json")]
    assert archive.bad_lines(lines, compressed=True).columns == ["session_id", "block_no", "line_no", "value"]

    put(tmp_path, "2024/a/b", "Heartbeat.json", BOM + '{"Utc":"2024-01-01T00:00:00Z"')
    put(tmp_path, "2024/a/c", "Heartbeat.json", BOM + '{"Utc":"2024-01-01T00:00:00Z"}')
    with pytest.raises(Exception, match="Malformed document"):
        archive.read_keyframes(spark, str(tmp_path), "Heartbeat.json").count()
    assert [r.session_id for r in archive.read_keyframes(spark, str(tmp_path), "Heartbeat.json", on_bad="drop").collect()] == ["2024/a/c"]
    docs = archive.read_documents(spark, archive.feed_paths(str(tmp_path), "Heartbeat.json"))
    assert [tuple(r) for r in archive.document_faults(docs).collect()] == [("2024/a/b", "json")]
    with pytest.raises(ValueError, match="on_bad"):
        archive.decode_documents(docs, on_bad="ignore")


def test_line_numbers_are_the_files_own(spark, tmp_path):
    for session, n in (("2024/a/b", 900), ("2024/a/c", 700)):
        put(tmp_path, session, "X.jsonStream", "".join(f'00:00:01.000{{"n":{i}}}\n' if i % 100 else "bad\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = archive.read_entries(spark, str(tmp_path), "X.jsonStream", on_bad="drop", numbered=True)
        season = {(r.session_id, r.line_no, r.payload) for r in rows.collect()}
        lines = archive.read_stream_lines(spark, archive.feed_paths(str(tmp_path), "X.jsonStream"), numbered=True)
        faults = sorted((r.session_id, r.line_no) for r in archive.line_faults(lines).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    one = archive.read_entries(spark, str(tmp_path), "X.jsonStream", ["2024/a/c"], on_bad="drop", numbered=True)
    assert {(r.session_id, r.line_no, r.payload) for r in one.collect()} == {x for x in season if x[0] == "2024/a/c"}
    assert season == {(s, i, f'{{"n":{i}}}') for s, n in (("2024/a/b", 900), ("2024/a/c", 700)) for i in range(n) if i % 100}
    assert faults == [(s, i) for s, n in (("2024/a/b", 900), ("2024/a/c", 700)) for i in range(0, n, 100)]


def test_a_feed_is_one_scan_and_one_parse(spark, tmp_path):
    put(tmp_path, "2024/a/b", "CarData.z.jsonStream", f'00:00:01.000"{packed({"Entries": []})}"\n')
    put(tmp_path, "2024/a/b", "DriverRaceInfo.jsonStream", '00:00:01.000{"44":{"Position":"1"}}\n')
    put(tmp_path, "2024/a/b", "TrackStatus.jsonStream", '00:00:01.000{"Status":"1","Message":"AllClear"}\n')
    for name in ("CarData", "DriverRaceInfo", "TrackStatus"):
        table = feeds.read_feed(spark, str(tmp_path), name)
        table.collect()
        plan = table._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
        assert plan.count("FileScan") == 1


def test_absent_files_give_no_rows(spark, tmp_path):
    put(tmp_path, "2024/m/s1", "TrackStatus.jsonStream", '00:00:01.000{"Status":"1","Message":"AllClear"}\n')
    put(tmp_path, "2024/m/s3", "Other.jsonStream", "x")
    found = feeds.read_feed(spark, str(tmp_path), "TrackStatus", sessions=["2024/m/s1", "2024/m/s3", "2024/m/s9"])
    assert [r.session_id for r in found.collect()] == ["2024/m/s1"]
    assert feeds.read_feed(spark, str(tmp_path), "PitStop").count() == 0
    assert feeds.read_feed(spark, str(tmp_path), "CarData", sessions=["2030/x/y"]).count() == 0
    assert archive.read_keyframes(spark, str(tmp_path), "PitStop.json", sessions=["2030/x/y"]).count() == 0


def test_stream_and_keyframe_are_read_apart(spark, tmp_path):
    """A reader of one of the two does not touch the other, which here cannot be decoded."""
    put(tmp_path, "2024/a/b", "Heartbeat.json", "{broken")
    put(tmp_path, "2024/a/b", "Heartbeat.jsonStream", '00:00:01.000{"Utc":"2024-01-01T00:00:00Z"}\n')
    rows = feeds.read_feed(spark, str(tmp_path), "Heartbeat")
    assert rows.count() == 1
    assert all(f.endswith("Heartbeat.jsonStream") for f in rows.inputFiles())
    put(tmp_path, "2024/a/c", "Heartbeat.json", '{"Utc":"2024-01-01T00:00:00Z"}')
    put(tmp_path, "2024/a/c", "Heartbeat.jsonStream", "broken\n")
    kept = archive.read_keyframes(spark, str(tmp_path), "Heartbeat.json", ["2024/a/c"])
    assert kept.count() == 1
    assert all(f.endswith("Heartbeat.json") for f in kept.inputFiles())


def test_session_feeds(spark, docs):
    paths = {"KeyFramePath": "CarData.z.json", "StreamPath": "CarData.z.jsonStream"}
    other = {"KeyFramePath": "PitStop.json", "StreamPath": "PitStop.jsonStream"}
    feeds_doc = {"CarData.z": paths, "PitStop": other}
    offered = index.session_feeds(docs(json.dumps({"Feeds": feeds_doc}), json.dumps(feeds_doc)))
    assert sorted((r.session_id, r.feed, r.compressed, r.known) for r in offered.collect()) == [
        ("s0", "CarData.z", True, True), ("s0", "PitStop", False, False),
        ("s1", "CarData.z", True, True), ("s1", "PitStop", False, False),
    ]
    asked = spark.createDataFrame([("s0", "CarData.z"), ("s0", "TeamRadio")], "session_id string, feed string")
    assert [tuple(r) for r in index.missing_feeds(asked, offered).collect()] == [("s0", "TeamRadio")]


def test_blobs_are_inflated_once(spark):
    lines = spark.createDataFrame([("2024/a/b", 0, 1, '00:00:01.000"')], "session_id string, block_no long, line_no long, value string")
    docs = spark.createDataFrame([("2024/a/b", '"')], "session_id string, doc string")
    for on_bad in ("raise", "drop"):
        for rows in (archive.inflate_lines(lines, on_bad), archive.decode_documents(docs, compressed=True, on_bad=on_bad)):
            assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
