from __future__ import annotations

import pytest

from statloom.session import local_session
from tests.oracle import connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 4, "4g")


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of dicts."""

    def read(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((r.asDict() for r in df.collect()), key=lambda r: [str(v) for v in r.values()])

    return read
