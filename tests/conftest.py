"""One session for all tests, and brute-force helpers."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rentscope.plans.saved import drop_saved  # noqa: E402
from rentscope.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g", spark__sql__shuffle__partitions="8")
    yield session
    drop_saved(session)
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def medium_dir():
    return MEDIUM
