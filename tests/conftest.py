import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from slipstream.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw entries of one session from ``(clock in ms, payload)`` pairs in arrival order."""

    def build(*entries, session="2024/a/b"):
        rows = [(session, 0, i, 0, ms, payload) for i, (ms, payload) in enumerate(entries)]
        return spark.createDataFrame(
            rows, "session_id string, block_no long, line_no long, entry_no int, timestamp_ms long, payload string"
        )

    return build


@pytest.fixture
def docs(spark):
    def build(*texts):
        return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(texts)], "session_id string, doc string")

    return build
