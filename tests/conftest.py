import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402

NOW = dt.datetime(2026, 7, 31, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tidemark-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Payload texts as raw rows that all arrive at NOW (UTC)."""

    def build(*values, now=NOW):
        rows = [(v,) for v in values]
        stamp = now.strftime("%Y-%m-%d %H:%M:%S.%f")
        return spark.createDataFrame(rows, "value string").selectExpr(
            "value", f"TIMESTAMP '{stamp}' AS arrived_at"
        )

    return build
