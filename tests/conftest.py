import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for entry in (str(ROOT), str(ROOT / "tools")):
    if entry not in sys.path:
        sys.path.insert(0, entry)

from ledgerloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        4,
        **{
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.memory": "6g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Sets session options for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
