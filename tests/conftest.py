"""One Spark session for all tests; what it stores goes to a folder of pytest's."""

import pytest

from tallyforge.testbed.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 8, "8g", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()
