"""One session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerlens.session import session

    s = session(
        "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
        spark__sql__autoBroadcastJoinThreshold="10m", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
