"""Every registered query against its check SQL on DuckDB, over the whole smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from slipstream.plans.registry import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TYPES = {
    "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="check tables not mounted")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def normal(rows):
    def value(x):
        return round(x, 9) if isinstance(x, float) and not math.isnan(x) else x

    return sorted((tuple(map(value, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    query = QUERIES[name]
    got = query.run(spark, str(SF_DIR))
    columns = sorted(got.columns)
    got_rows = got.select(*columns).collect()
    assert got_rows
    if query.sql is None:
        return
    want = duck.sql(query.sql)
    place = {c: i for i, c in enumerate(want.columns)}
    assert sorted(place) == columns
    types = {f.name: TYPES[f.dataType.simpleString()] for f in got.schema.fields}
    assert {c: str(want.types[i]) for c, i in place.items()} == types
    want_rows = [tuple(r[place[c]] for c in columns) for r in want.fetchall()]
    assert normal(got_rows) == normal(want_rows)
