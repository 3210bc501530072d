import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from slotwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(v)) for v in t])

    return collect
