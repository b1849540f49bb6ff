from __future__ import annotations

import pytest

from ledgerspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
