import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0 = "/root/testdata/sf0.001"
SF1 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from factorspark.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    if not s.sparkContext.getCheckpointDir():             # tests only: a scratch folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fs-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
