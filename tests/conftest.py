import pytest

from stockweave.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", partitions=8, app="stockweave-tests")
    yield session
    session.stop()
