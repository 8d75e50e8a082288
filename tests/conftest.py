import os

import pytest

from objsync.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), "objsync-tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
