"""Payload shapes: snapshots and deltas, odd children, loose types, repeated keys, and the compat switches."""

import datetime as dt
import json

from slipstream.operators import catalog, feeds


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def one(raw, flatten, payload, *columns, **options):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return rows(flatten(raw((1000, text)), **options), *columns)


def test_car_data_loose_types_and_defaults(raw):
    payload = {
        "Utc": "2023-11-26T13:03:33.1234567Z",
        "Cars": {
            "44": {"Channels": {"0": "10500", "2": 301, "3": 8, "4": 99.5, "5": 104, "45": 12}},
            "1": {"Channels": {}},
            "2": {"Channels": {"0": None, "2": "fast"}},
            "3": None,
            "4": "out",
            "5": {"Channels": [1]},
            "6": {},
        },
    }
    got = one(raw, feeds.car_data, payload, "racing_number", "rpm", "speed", "gear", "throttle", "brake", "drs")
    assert got == sorted(
        [
            (44, 10500, 301, 8, 99.5, 104, 12),
            (1, 0, 0, 0, 0.0, 0, None),
            (2, None, None, 0, 0.0, 0, None),
            (5, 0, 0, 0, 0.0, 0, None),
            (6, 0, 0, 0, 0.0, 0, None),
        ],
        key=repr,
    )
    assert feeds.car_data(raw((1, json.dumps(payload)))).first().utc == dt.datetime(2023, 11, 26, 13, 3, 33, 123456)
    for empty in ("{}", '{"Cars":null}', '{"Cars":[1]}', '{"Cars":{}}'):
        assert one(raw, feeds.car_data, empty, "rpm") == []


def test_repeated_keys_keep_the_last_value(raw):
    text = '{"Cars":{"44":{"Channels":{"0":1}},"1":{"Channels":{"0":2}},"44":{"Channels":{"0":3}}}}'
    assert one(raw, feeds.car_data, text, "racing_number", "rpm", "key_pos") == [(1, 2, 1), (44, 3, 0)]
    text = '{"44":{"Line":1},"44":{"Line":2}}'
    assert one(raw, feeds.driver_list, text, "car_number", "line") == [("44", 2)]


def test_position(raw):
    payload = {"Timestamp": "t", "Entries": {"44": {"Status": "OnTrack", "X": 1, "Y": "2.5", "Z": None}, "1": 5}}
    assert one(raw, feeds.position, payload, "utc", "racing_number", "status", "x", "y", "z") == [("t", 44, "OnTrack", 1.0, 2.5, None)]


def test_timing_segments_lists_and_objects(raw):
    payload = {
        "Lines": {
            "44": {"Sectors": [{"Segments": [{"Status": 2048}, {"Status": None}, {}]}, {"Segments": {"3": {"Status": "2051"}}}]},
            "1": {"Sectors": {"2": {"Segments": {"0": {"Status": 0}, "1": None}}, "0": {"Value": "1"}}},
            "2": {"Sectors": None},
            "3": [],
        }
    }
    assert one(raw, feeds.timing_segments, payload, "car_number", "sector", "segment", "status") == [
        ("1", 3, 0, 0), ("44", 1, 0, 2048), ("44", 2, 3, 2051),
    ]


def test_timing_stats_kinds(raw):
    payload = {
        "Lines": {
            "44": {
                "BestSpeeds": {"I1": {"Value": "290", "Position": 3}, "ST": {"Value": ""}, "FL": None},
                "BestSectors": {"1": {"Value": "26.5"}},
                "PersonalBestLapTime": {"Value": "1:26.933", "Lap": 45},
            },
            "1": {"BestSpeeds": [1], "BestSectors": [{"Value": 20.1, "Position": 1}], "PersonalBestLapTime": "x"},
        }
    }
    columns = ["car_number", "stat_type", "position", "trap", "speed", "sector", "time_seconds", "lap_time_ms", "lap"]
    assert one(raw, feeds.timing_stats, payload, *columns) == sorted(
        [
            ("44", "speed", 3, "I1", 290, None, None, None, None),
            ("44", "speed", None, "ST", None, None, None, None, None),
            ("44", "sector", None, None, None, 1, 26.5, None, None),
            ("44", "personal_best", None, None, None, None, None, 86933, 45),
            ("1", "sector", 1, None, None, 0, 20.1, None, None),
        ],
        key=repr,
    )


def test_stints_read_text_flags_only(raw):
    payload = {"Lines": {"44": {"Stints": [{"Compound": "SOFT", "New": "true", "TyresNotChanged": "0", "TotalLaps": 3}]}, "1": {"Stints": {"2": {"New": True}}}}}
    columns = ["car_number", "stint_number", "compound", "new", "tyres_not_changed", "total_laps"]
    assert one(raw, feeds.timing_app, payload, *columns) == [("1", 2, None, None, None, None), ("44", 0, "SOFT", True, 0, 3)]


def test_list_snapshots_and_compat(raw):
    stints = {"Stints": {"44": [{"Compound": "SOFT", "New": "false"}], "1": {"0": {"Compound": "HARD"}}}}
    assert one(raw, feeds.tyre_stints, stints, "car_number", "compound", "new") == [(1, "HARD", None), (44, "SOFT", False)]
    assert one(raw, feeds.tyre_stints, stints, "car_number", compat=True) == [(1,)]
    laps = {"44": {"LapPosition": ["3", 2]}, "1": {"LapPosition": {"7": 5}}}
    assert one(raw, feeds.lap_series, laps, "racing_number", "lap", "position") == [(1, 7, 5), (44, 0, 3), (44, 1, 2)]
    assert one(raw, feeds.lap_series, laps, "racing_number", compat=True) == [(1,)]
    top = {"Lines": [{"RacingNumber": "44"}]}
    assert one(raw, feeds.top_three, top, "position", "racing_number") == [(1, 44)]
    assert one(raw, feeds.top_three, top, "position", compat=True) == []


def test_lap_count_totals(raw):
    df = feeds.lap_count(raw((1, '{"TotalLaps":57}'), (2, '{"CurrentLap":3}'), (3, '{"TotalLaps":"99"}'), (4, '{"TotalLaps": 58,"CurrentLap":2}')))
    assert rows(df, "lap", "total_laps") == sorted([(None, 57), (3, None), (None, None), (2, 58)], key=repr)
    assert [tuple(r) for r in catalog.lap_totals(df).collect()] == [("2024/a/b", 58, 3)]
    assert [tuple(r) for r in catalog.lap_totals(feeds.lap_count(raw((1, "{}")))).collect()] == [("2024/a/b", 0, 0)]


def test_driver_tracker_gaps(raw):
    payload = {"Lines": {"44": {"LapState": 5, "LapTime": "26.9", "DiffToAhead": "+1.5", "DiffToLeader": "2L"}, "1": {"DiffToAhead": 1.5, "LapTime": ""}}}
    columns = ["racing_number", "lap_state", "lap_time_ms", "diff_to_ahead", "diff_to_leader"]
    assert one(raw, feeds.driver_tracker, payload, *columns) == [(1, None, None, None, None), (44, 5, 26900, 1.5, -2.0)]


def test_pit_stop_lap_from_the_row_before(raw):
    df = feeds.pit_stop(raw((1, '{"RacingNumber":"1"}'), (2, '{"RacingNumber":"44","Lap":"9"}'), (3, '{"RacingNumber":"5","PitStopTime":"2.4"}')))
    assert rows(df, "timestamp_ms", "racing_number", "pit_stop_time", "lap") == [(1, 1, None, None), (2, 44, None, 9), (3, 5, 2.4, 9)]


def test_pit_stop_series(raw):
    payload = '{"PitTimes":{"44":{"9":{"PitStop":{"Lap":9}},"2":{"PitStop":{"Lap":2}}},"1":[{"PitStop":{"Lap":1}},{}],"3":{},"4":{"0":null},"5":"x"}}'
    assert one(raw, feeds.pit_stop_series, payload, "racing_number", "lap") == sorted([(1, 1), (1, None), (44, 9), (44, 2)], key=repr)
    assert one(raw, feeds.pit_stop_series, payload, "racing_number", "lap", compat=True) == [(1, 1), (44, 9)]


def test_pit_lane_deletes(raw):
    def insert(car, seconds):
        return {"RacingNumber": car, "Duration": seconds, "Lap": "3"}

    entries = [
        (1, {"PitTimes": {"_deleted": ["44"]}}),  # nothing to cancel yet
        (2, {"PitTimes": {"44": insert("44", "20.1"), "1": insert("1", "21")}}),
        (3, {"PitTimes": {"_deleted": ["44", "1"]}}),
        (4, {"PitTimes": {"_deleted": ["44"]}}),  # overwrites
        (5, {"PitTimes": {"_deleted": ["1"], "44": insert("44", "22")}}),  # mixed
        (6, {"PitTimes": []}),
    ]
    df = raw(*[(ms, json.dumps(p)) for ms, p in entries])
    columns = ["timestamp_ms", "racing_number", "duration", "broadcast_deleted_at_ms"]
    assert rows(feeds.pit_lane_times(df), *columns) == [(2, 1, 21.0, 5), (2, 44, 20.1, 4), (5, 44, 22.0, None)]
    assert rows(feeds.pit_lane_times(df, compat=True), *columns) == [(2, 1, 21.0, 5), (2, 44, 20.1, None)]


def test_pit_lane_compat_keeps_marks_of_insert_entries(raw):
    text = '{"PitTimes":{"44":{"RacingNumber":"44","Duration":"20"},"_deleted":["44"]}}'
    columns = ["duration", "broadcast_deleted_at_ms"]
    assert one(raw, feeds.pit_lane_times, text, *columns) == [(20.0, 1000)]
    assert one(raw, feeds.pit_lane_times, text, *columns, compat=True) == [(20.0, None), (None, 1000)]


def test_weather_series(raw):
    listed = {"Series": [{"Timestamp": "2024-01-01T00:00:00Z", "Weather": {"AirTemp": "20.5"}}, {"Weather": {"AirTemp": "21"}}]}
    assert one(raw, feeds.weather_series, listed, "air_temp") == [(20.5,), (21.0,)]
    assert one(raw, feeds.weather_series, listed, "air_temp", compat=True) == [(20.5,)]
    keyed = {"Series": {"4": [{"Weather": {"AirTemp": 1}}, {"Weather": {"AirTemp": 2}}], "5": None, "6": {"Weather": {"AirTemp": 3}}}}
    assert one(raw, feeds.weather_series, keyed, "air_temp") == [(1.0,), (2.0,), (3.0,)]
    assert one(raw, feeds.weather_series, keyed, "air_temp", compat=True) == [(1.0,), (3.0,)]


def test_driver_race_info_and_grid(raw):
    entries = [
        (0, {"44": {"Position": "2"}, "1": {"Position": 1}, "5": {"Gap": ""}, "x": 1}),
        (7, {"44": {"Gap": "LAP 3", "Catching": 2, "OvertakeState": 9}}),
        (7, {"44": {"Gap": "+1 LAP", "Interval": "+1:00.5", "Catching": "2", "OvertakeState": 0, "IsOut": True}}),
        (8, {"44": {"PitStops": 2, "Gap": 1.5}}),
    ]
    df = raw(*[(ms, json.dumps(p)) for ms, p in entries])
    assert [tuple(r) for r in feeds.starting_grid(df).select("position", "car_number").collect()] == [(1, "1"), (2, "44")]
    columns = ["timestamp_ms", "car_number", "gap_seconds", "laps_behind", "interval_seconds", "catching", "overtake_state", "is_leader", "pit_stops", "is_out"]
    assert rows(feeds.driver_race_info(df), *columns) == [
        (7, "44", None, 1, 60.5, None, "lost_position", False, None, True),
        (8, "44", None, 0, None, None, None, False, 2, None),
    ]


def test_overtakes_read_either_spelling(raw):
    payload = {"Overtakes": {"44": {"1": {"Timestamp": "2024-01-01T00:00:00.1239Z", "count": 2}}, "1": [{"Count": 3}]}}
    assert one(raw, feeds.overtakes, payload, "utc", "racing_number", "count") == sorted(
        [(dt.datetime(2024, 1, 1, 0, 0, 0, 123000), 44, 2), (None, 1, 3)], key=repr
    )


def test_session_data_items_and_compat(raw):
    payload = '{"Series":[{"Utc":"2024-01-01T00:00:00Z","Lap":1},{"Lap":2}],"StatusSeries":{"3":{"TrackStatus":"Red"},"4":{"SessionStatus":"Started"}}}'
    columns = ["series_type", "lap", "track_status", "session_status"]
    assert one(raw, feeds.session_data, payload, *columns) == sorted(
        [("Series", 1, None, None), ("Series", 2, None, None), ("StatusSeries", None, "Red", None), ("StatusSeries", None, None, "Started")],
        key=repr,
    )
    assert one(raw, feeds.session_data, payload, *columns, compat=True) == [("StatusSeries", None, None, "Started")]
    assert one(raw, feeds.session_data, "{}", *columns, compat=True) == [(None, None, None, None)]


def test_flat_feeds_and_small_ones(raw):
    assert one(raw, feeds.track_status, {"Status": "2", "Message": "Yellow"}, "status", "message") == [(2, "Yellow")]
    assert one(raw, feeds.session_status, {"Status": "Started"}, "status", "started") == [("Started", None)]
    assert one(raw, feeds.archive_status, {"Status": "Complete"}, "status", "timestamp_ms") == [("Complete", 1000)]
    assert one(raw, feeds.weather, {"AirTemp": "1013.25", "WindDirection": 180}, "air_temp", "wind_direction", "humidity") == [(1013.25, 180, None)]
    assert one(raw, feeds.heartbeat, {"Utc": 5}, "utc") == [(None,)]
    assert one(raw, feeds.current_tyres, {"Tyres": {"44": {"Compound": "C5"}}}, "racing_number", "compound", "new") == [(44, "UNKNOWN", False)]
    messages = {"Messages": {"7": {"Category": "Flag", "Message": "say \"hi\" {", "Lap": 3}, "8": 1}}
    assert one(raw, feeds.race_control, messages, "category", "message", "lap") == [("Flag", 'say "hi" {', 3)]
    standings = {"Drivers": {"44": {"PredictedPosition": 1}}, "Teams": {"A": {"PredictedPoints": 10.5}, "B": None}}
    assert one(raw, feeds.championship, standings, "entry_type", "entry_key", "predicted_position", "predicted_points") == [
        ("driver", "44", 1, None), ("team", "A", None, 10.5),
    ]
    streams = {"Streams": [{"Type": "Audio", "Name": "FX", "Path": "p"}, None]}
    assert one(raw, feeds.content_streams, streams, "type", "name", "path", "utc") == [("Audio", "FX", "p", None)]


def test_every_feed_survives_empty_and_alien_payloads(raw):
    df = raw((1, "{}"), (2, '{"Lines":5,"Cars":[1],"Messages":"x","44":[1],"Entries":{"1":null}}'))
    for feed in feeds.FEEDS.values():
        feed.flatten(df).collect()


def test_a_nested_field_of_the_same_name_is_not_the_field(raw):
    payload = '{"Lines":{"1":{"DiffToAhead":5,"Extra":{"DiffToAhead":"x"}},"2":{"DiffToAhead":"5","Extra":{"DiffToAhead":1}}}}'
    assert one(raw, feeds.driver_tracker, payload, "diff_to_ahead") == sorted([(None,), (5.0,)], key=repr)
    assert one(raw, feeds.lap_count, '{"Deep":{"TotalLaps":"9"},"TotalLaps" : 7}', "total_laps") == [(7,)]
    assert one(raw, feeds.lap_count, '{"Deep":{"TotalLaps":9},"TotalLaps" : "7"}', "total_laps") == [(None,)]


def test_the_last_of_equal_keys_counts(raw):
    payload = '{"Lines":{"1":{"BestSpeeds":{"I1":{"Value":"1","Position":1},"I1":{"Value":"2","Position":2}}}}}'
    found = one(raw, feeds.timing_stats, payload, "stat_type", "trap", "speed")
    assert [r for r in found if r[0] == "speed"] == [("speed", "I1", 2)]
