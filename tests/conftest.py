import pytest

from quayside.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "quayside-tests",
        master="local[4]",
        spark__sql__shuffle__partitions=4,
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="4g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
