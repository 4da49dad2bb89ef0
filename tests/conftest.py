import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from racestream.session import build_session, checkpoint_root, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # a private folder only where the session names none
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="racestream-test-")

