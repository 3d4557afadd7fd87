from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from spendlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", shuffle_partitions=4)
    yield session
    session.stop()


def rows(frame, *columns):
    """Sorted tuples of the named columns."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
