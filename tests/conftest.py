import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barloom.session import build_session

    session = build_session("local[4]", "barloom-tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
