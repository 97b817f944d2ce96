import pytest

from leadspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("8", app="tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
