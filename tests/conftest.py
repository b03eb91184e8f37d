import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", shuffle_partitions=8, app="rillflow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def gate(spark):
    """Every catalogue query run once at the scale of the driver's gate: (outcomes, plans)."""
    from oracle_check import compare
    plans = {}
    return compare(spark, SF_CHECK, plans=plans), plans


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
