import pytest

from tests.oracle import session


@pytest.fixture(scope="session")
def spark():
    return session()
