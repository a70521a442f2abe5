import os
import sys
import tempfile
from datetime import UTC, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shiftledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shiftledger-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """rows(schema, *tuples) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


def utc(text: str) -> datetime:
    """'2026-01-31T21:59:59' as an aware UTC instant."""
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def ids(df, column="source_id"):
    return sorted(r[0] for r in df.select(column).collect())
