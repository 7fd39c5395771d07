from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from couponlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.01"


@pytest.fixture
def rows():
    """Collects a DataFrame as a list of dicts."""
    return lambda df: [r.asDict(recursive=True) for r in df.collect()]
