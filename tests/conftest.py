import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

# Python workers import the package too
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8)
    # tests set their own checkpoint dir (a cluster names a shared one)
    if not s.sparkContext.getCheckpointDir():
        ck = tempfile.mkdtemp(prefix="ledgerlens-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", ck)
        s.sparkContext.setCheckpointDir(ck)
    yield s
    s.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="ledgerlens-test-")
