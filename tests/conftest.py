import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from kpi_shift.session import local_session

    session = local_session(8, "kpi_shift-tests")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    before = {}

    def apply(**pairs):
        for key, value in pairs.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield apply
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
