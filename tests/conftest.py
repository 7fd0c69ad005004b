from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallycast.plans.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="tallycast-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    s = local_session("*", shuffle_partitions=8, scratch=scratch)
    yield s
    s.stop()


def stat_frame(spark, rows):
    """Statistics rows (attack_type, sum, year, month, day, hour) -> normalised frame."""
    from tallycast.sources.tables import STAT_SCHEMA, normalize
    return normalize(spark.createDataFrame(rows, STAT_SCHEMA))
