from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtally.session import STREAMING_CONF, build  # noqa: E402

CHANGES = (
    "seq BIGINT, kind STRING, bid_id STRING, campaign_id STRING, event_ts TIMESTAMP, arrival_ts TIMESTAMP"
)


@pytest.fixture(scope="session")
def spark():
    session = build(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            **STREAMING_CONF,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def changes_of(spark):
    """Rows ``(seq, kind, bid_id, campaign_id, minute)`` as a changes relation."""

    def make(rows):
        full = [
            (seq, kind, bid_id, campaign, utc(2024, 1, 1, minute // 60, minute % 60), utc(2024, 1, 1, 0, 0, seq % 60))
            for seq, kind, bid_id, campaign, minute in rows
        ]
        return spark.createDataFrame(full, CHANGES)

    return make
