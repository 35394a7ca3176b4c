import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from plait.session import local_session
    s = local_session(4, shuffle_partitions=4, app="plait-tests")
    # tests own their shared folder only where none is configured
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plait-test-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from plait.session import scratch_path
    return scratch_path(spark, "test")
