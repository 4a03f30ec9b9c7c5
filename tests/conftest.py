import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402

EPOCH = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return EPOCH + timedelta(seconds=seconds)


def secs(ts: datetime) -> float:
    return (ts - EPOCH).total_seconds()


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tidemark-tests", "4g", **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()
