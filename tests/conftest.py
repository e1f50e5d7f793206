import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridlens.session import build_session

    s = build_session(
        "local[*]",
        app_name="gridlens-tests",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    # tests set their own checkpoint folder (a cluster names a shared one)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_factory_path():
    return tempfile.mkdtemp(prefix="gridlens-test-")
