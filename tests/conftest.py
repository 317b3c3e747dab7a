import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from clickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con(sf_dir):
    from check_oracles import duck

    return duck(sf_dir)
