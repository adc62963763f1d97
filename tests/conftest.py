import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from compare import local_session  # noqa: E402
from kelvane.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(local_session())


@pytest.fixture
def root(spark, tmp_path):
    from kelvane.sinks.tables import ensure_tables
    path = str(tmp_path / "tables")
    ensure_tables(spark, path)
    return path
