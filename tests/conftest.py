import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from textloom.session import local_session

    session = local_session("tests", cores=8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
