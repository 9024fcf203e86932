import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


def pytest_addoption(parser):
    parser.addoption("--all-queries", action="store_true", help="compare every registered query with its oracle")


@pytest.fixture(scope="session")
def spark():
    from eventloom.session import local_session

    session = local_session(4, "4g", "eventloom-tests")
    yield session
    session.stop()
