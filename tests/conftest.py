import pytest

from tillmart.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tillmart-tests")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
