"""Every registered query against its SQL form on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, name):
    verdict, _ = compare(spark, con, SF_DIR, name, entry.oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows=")), verdict


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
