import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    # A fresh warehouse per test session: managed tables of earlier runs must
    # not collide with the ones a test creates.
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-test-wh-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
