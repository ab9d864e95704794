import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ledgerline.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # the shared folder comes from spark.checkpoint.dir when configured;
    # ledgerline.session.shared_dir creates a private one only where it is unset
    session = build_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh local folder per test (local test runs only)."""
    return str(tmp_path)
