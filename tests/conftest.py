import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.path.join(os.path.dirname(os.path.abspath(__file__)), "data")


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session

    ckpt = tempfile.mkdtemp(prefix="ledgerflow-test-ckpt-")
    s = build_session(
        "local[8]",
        app_name="ledgerflow-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="ledgerflow-test-")
