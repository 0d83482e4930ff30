import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stratiform.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app="stratiform-tests")
    # use the configured checkpoint folder; only when none is configured, a fresh local one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stratiform-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from stratiform.session import new_scratch_dir
    return lambda tag="t": new_scratch_dir(spark, tag)
