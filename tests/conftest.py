import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import get_session

    s = get_session("local[*]", shuffle_partitions=8)
    # tests own this session, so they may name the shared folder (a cluster names its own)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-test-ckpt-"))
    yield s
    s.stop()
