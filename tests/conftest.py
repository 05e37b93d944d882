import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lakefold.session import build_session

    ckpt = tempfile.mkdtemp(prefix="lakefold-test-ckpt-")
    s = build_session(
        "lakefold-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakefold-test-")
