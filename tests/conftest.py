import datetime
import sys
import tempfile
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cohortia.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.driver.host": "localhost",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A fresh folder per test; it is left in place."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df):
    return Counter(tuple(row) for row in df.collect())


def same(left, right):
    """Equal as multisets, both ways."""
    return rows(left) == rows(right)


def day(text):
    return datetime.date.fromisoformat(text)
