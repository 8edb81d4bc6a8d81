"""One session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lontar.session import local_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    ship(s)
    yield s
    s.stop()
