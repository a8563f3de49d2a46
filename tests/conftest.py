import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TESTDATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfwise.session import build_session

    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__driver__memory="6g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("test data not present")
    return str(path)
