import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(4, shuffle_partitions=8, app="tessera-tests")
    # tests run locally: set our own checkpoint folder only because it is unset
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
