import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    scratch = tempfile.mkdtemp(prefix="tessera-test-", dir="/tmp")
    s = get_session("local[4]", app="tessera-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                           "spark.local.dir": scratch})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-t-", dir="/tmp")
