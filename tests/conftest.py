import pytest

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, driver_memory="2g")
    yield s
    s.stop()
