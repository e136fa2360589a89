import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from bazaar.session import local_session

    s = local_session("*", 8, app="bazaar-tests")
    # tests only: a checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bazaar-ckpt-"))
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="bazaar-test-")
