import os
import tempfile

import pytest

from fleetpulse.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session("fleetpulse-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "2",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fleetpulse-tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
