import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from playlake.session import build_session

    session = build_session(master="local[4]", app_name="playlake-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def lake_dir(spark):
    """A fresh folder under the session's shared scratch root."""
    from playlake.session import scratch_path

    return scratch_path(spark, "test")
