"""One local session for all tests."""

import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TESTDATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidegate.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test tables are not mounted")
    return str(folder)
