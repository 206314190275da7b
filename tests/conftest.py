import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsebook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests", "6g")
    yield s
    s.stop()


@pytest.fixture
def split(spark):
    """Cut every key about every second row."""
    spark.conf.set("pulsebook.split.rows", "7")
    yield
    spark.conf.unset("pulsebook.split.rows")
