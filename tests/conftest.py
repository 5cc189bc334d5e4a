import pytest

from tests.oracle_check import TESTDATA, connect
from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    return connect(sf_dir)
