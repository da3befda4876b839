import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tablekit.session import get_session
    base = tempfile.mkdtemp(prefix="tablekit-test-")
    s = get_session(app="tablekit-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.warehouse.dir": os.path.join(base, "warehouse"),
        "spark.checkpoint.dir": os.path.join(base, "checkpoints"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={base}/derby",
    })
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


SF_SMALL = "/root/testdata/sf0.001"
