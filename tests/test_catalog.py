"""Every registered query against DuckDB on the smallest driver tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import compare  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
from sparklogs.plans import catalog  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.all_queries()))
def test_query(spark, con, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    assert compare.differences(frame, con, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
