"""Lookups on a small season with a test weekend, a repeated round number and a cancelled session."""

import json

import pytest

from slipstream.operators import catalog
from slipstream.sources import index


def session(key, name, start, end=None, path="2023/x/"):
    return {"Key": key, "Type": "Practice", "Name": name, "StartDate": start, "EndDate": end, "GmtOffset": "-03:30:00", "Path": path}


def meeting(key, number, name, location, country, sessions):
    return {
        "Key": key, "Code": "C", "Number": number, "Location": location, "OfficialName": name.upper(), "Name": name,
        "Country": {"Key": 1, "Code": "X", "Name": country}, "Circuit": {"Key": 2, "ShortName": location}, "Sessions": sessions,
    }


SEASON = {
    "Year": 2023,
    "Meetings": [
        meeting(3, 2, "Italian Grand Prix", "Monza", "Italy", [
            session(31, "Race", "2023-09-03T15:00:00", None, "2023/2023-09-03_Italian/2023-09-03_Race/"),
            session(32, "Sprint Qualifying", "2023-09-01T15:00:00", "2023-09-01T16:00:00", None),
            session(33, "Sprint", "2023-09-02T15:00:00", "2023-09-02T16:00:00", "2023/2023-09-03_Italian/2023-09-02_Sprint/"),
        ]),
        meeting(1, 1, "Pre-Season Testing", "Sakhir", "Bahrain", [session(11, "Day 1", "2023-02-23T10:00:00", None, "2023/2023-02-25_Test/2023-02-23_Practice_1/")]),
        meeting(2, 1, "Bahrain Grand Prix", "Sakhir", "Bahrain", [{"Key": -1, "StartDate": "2023-03-03T10:00:00", "GmtOffset": "03:00:00"}]),
    ],
}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([("", json.dumps(SEASON))], "session_id string, doc string")
    return index.meetings(docs).cache(), index.sessions(docs).cache()


def test_session_address_and_types(tables):
    got = {r.session_key: r for r in tables[1].collect()}
    assert (got[31].path_year, got[31].meeting_folder, got[31].session_folder) == ("2023", "2023-09-03_Italian", "2023-09-03_Race")
    assert (got[32].name, got[32].path, got[32].gmt_offset_s) == ("Sprint Shootout", None, -12600)
    assert (got[11].name, got[-1].name, got[-1].path, got[-1].number) == ("Practice 1", None, None, None)


def test_meeting_search(spark, tables):
    asked = [("a", 2023, " monza "), ("b", 2023, "sakhir"), ("c", 2023, "grand prix"), ("d", 2023, "nowhere"), ("e", 2022, "monza"), ("f", 2023, "2023-09-03_it")]
    queries = spark.createDataFrame(asked, "query_id string, year int, text string")
    got = {r.query_id: r for r in catalog.search_meetings(queries, *tables).collect()}
    assert (got["a"].status, got["a"].meeting_key, got["a"].folder) == ("found", 3, "2023-09-03_Italian")
    assert (got["b"].status, got["b"].meeting_key) == ("found", 2)  # the other hit is a test
    assert (got["c"].status, got["c"].candidates) == ("ambiguous", "Bahrain Grand Prix (Sakhir); Italian Grand Prix (Monza)")
    assert [got[k].status for k in "def"] == ["none", "none", "found"]


def test_meeting_search_by_texts_of_any_length(spark, tables):
    texts = ["", " ", "m", "mo", "mon", "ITAL", "za", "zz", "x", "2023-09-03_italian", "grand prix", "n g", "pre-season testing of"]
    queries = spark.createDataFrame([(t, 2023, t) for t in texts] + [("null", 2023, None)], "query_id string, year int, text string")
    got = {r.query_id: r.candidates for r in catalog.search_meetings(queries, *tables).collect()}
    fields = {"Pre-Season Testing (Sakhir)": ["pre-season testing", "sakhir", "bahrain", "2023-02-25_test"], "Bahrain Grand Prix (Sakhir)": ["bahrain grand prix", "sakhir", "bahrain"],
              "Italian Grand Prix (Monza)": ["italian grand prix", "monza", "italy", "2023-09-03_italian"]}
    assert got == {t: "; ".join(m for m, f in fields.items() if any(t.strip().lower() in x for x in f)) for t in texts} | {"null": ""}


def test_search_joins_on_grams(spark, tables):
    queries = spark.createDataFrame([("a", 2023, "monza")], "query_id string, year int, text string")
    plan = catalog.search_meetings(queries, *tables)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join" in line and "_fields" in line]
    assert joins and all("_gram" in line for line in joins)


def test_session_search(spark, tables):
    asked = spark.createDataFrame([("a", 2023, 3, "sprint"), ("b", 2023, 3, "Race"), ("c", 2023, 3, "q")], "query_id string, year int, meeting_key int, text string")

    def keys(compat):
        found = catalog.search_sessions(asked, tables[1], compat=compat).collect()
        return {r.query_id: r.session_key for r in found}

    assert keys(False) == {"a": 33, "b": 31, "c": None}
    assert keys(True) == {"a": 32, "b": 31, "c": None}


def test_types_spans_and_listing(tables):
    by_type = {r.meeting_key: r for r in catalog.sessions_by_type(tables[1]).collect()}
    assert (by_type[3].sq, by_type[3].sprint, by_type[3].race, by_type[3].fp1, by_type[1].fp1) == (32, 33, 31, None, 11)
    spans = {r.meeting_key: (str(r.weekend_start), str(r.weekend_end)) for r in catalog.weekend_span(tables[1]).collect()}
    assert spans[3] == ("2023-09-01 15:00:00", "2023-09-03 15:00:00")
    listing = catalog.season_listing(*tables).collect()
    assert [r.meeting_rank for r in listing] == [1, 2, 3]
    assert [(r.meeting_key, r.session_key, r.session_rank) for r in catalog.ordered_sessions(tables[1]).collect() if r.meeting_key == 3] == [(3, 32, 1), (3, 33, 2), (3, 31, 3)]
    assert [(r.name, r.sessions) for r in listing] == [
        ("Pre-Season Testing", "Practice 1"), ("Bahrain Grand Prix", "None"), ("Italian Grand Prix", "Sprint Shootout, Sprint, Race"),
    ]


def test_seasons_and_messages(spark, tables):
    assert [r.year for r in catalog.available_seasons(spark, tables[0], last=2024).collect()] == [2023]
    messages = spark.createDataFrame([("a",), ("a",), ("b",)], "session_id string")
    sessions = spark.createDataFrame([(2023, "a"), (2023, "b"), (2023, "c")], "year int, session_id string")
    got = catalog.messages_per_session(messages, sessions).orderBy("session_id").collect()
    assert [(r.messages, r.season_mean) for r in got] == [(2, 1.0), (1, 1.0), (0, 1.0)]
