import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatterlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def make_posts(spark):
    """Rows given as dicts of the interesting fields; the rest is filled in."""
    from datetime import UTC, datetime

    from chatterlens.schema import POST_SCHEMA

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            base = {
                "post_id": i,
                "ingest_seq": i,
                "username": "u",
                "timestamp": datetime(2024, 1, 1, tzinfo=UTC),
                "content": "text",
                "likes": 0,
                "replies": 0,
                "reposts": 0,
                "hashtags": [],
                "mentions": [],
            }
            full.append({**base, **row})
        return spark.createDataFrame(full, POST_SCHEMA)

    return make
