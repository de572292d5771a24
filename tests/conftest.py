import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from millrace import configure
    from oracle import session

    return configure(session())


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def con(folder):
    from oracle import database

    return database(folder)
