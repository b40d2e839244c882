import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelane.operators.chunks import ROWS_PER_CHUNK  # noqa: E402
from tidelane.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", "tests")


@pytest.fixture
def chunked(spark):
    """Set the rows per chunk for one test."""

    def use(n):
        spark.conf.set(ROWS_PER_CHUNK, str(n))

    yield use
    spark.conf.unset(ROWS_PER_CHUNK)
