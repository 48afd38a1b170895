from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from forespell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def entries(spark):
    """A dictionary DataFrame from (text, weight) pairs."""
    return lambda pairs: spark.createDataFrame(list(pairs), "text STRING, weight BIGINT")


@pytest.fixture
def shuffled(monkeypatch):
    """Treat every query table as too large to broadcast."""
    from forespell.plans import prefixes

    monkeypatch.setattr(prefixes, "BROADCAST_ROWS", -1)
