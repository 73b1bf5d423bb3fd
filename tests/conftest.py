import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowlake.session import get_session

    s = get_session("local[4]", app="flowlake-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="flowlake-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="flowlake-test-")
