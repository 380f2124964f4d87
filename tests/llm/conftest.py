import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def small():
    folder = DATA / "sf0.001"
    if not folder.is_dir():
        pytest.skip("no test tables")
    return str(folder)


@pytest.fixture(scope="session")
def medium():
    folder = DATA / "sf0.01"
    if not folder.is_dir():
        pytest.skip("no test tables")
    return str(folder)
