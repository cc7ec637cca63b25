import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session, work_path  # noqa: E402
from workloads.stores import ensure_work_folder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    ensure_work_folder(session)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return work_path(spark, "test")


@pytest.fixture
def at():
    """Timestamps of one January day, by hour and minute."""
    return lambda hour, minute=0, day=1: datetime(2024, 1, day, hour, minute)
