import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lodgelens.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="lodgelens-tests", shuffle_partitions=4)
    checkpoint_dir(s)  # unset in tests -> a local folder (local master only)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    # a fresh folder per test; nothing is ever deleted in place
    return tempfile.mkdtemp(prefix="lodgelens-test-")


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
