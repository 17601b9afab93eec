import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from beaconlake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, "tests", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def payloads(spark):
    """Raw payloads from texts; `seq` counts from 0."""

    def make(*texts, source="s"):
        rows = [(source, seq, text) for seq, text in enumerate(texts)]
        frame = spark.createDataFrame(rows, "source string, seq bigint, payload string")
        return frame.selectExpr("source", "seq", "timestamp_seconds(1710760000 + seq) AS fetched_at", "payload")

    return make
