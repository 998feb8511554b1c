"""Every registered query against its SQL, on the smallest driver tables."""

from pathlib import Path

import pytest

from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"

if not Path(SF_DIR).exists():
    pytest.skip("driver tables are not here", allow_module_level=True)

import __spark_entry__ as entry  # noqa: E402
from pairprep.plans import catalog, oracle  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["split", "before", "after", "kept_pct"]


def test_every_query_has_sql():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()


def test_every_query_is_registered():
    assert catalog.queries().keys() <= entry.queries().keys()
