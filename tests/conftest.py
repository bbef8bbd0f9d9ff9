import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fanline.session import build_session, checkpoint_dir

    s = build_session(
        "local[4]",
        app="fanline-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"},
    )
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="fanline-test-", dir="/tmp")
