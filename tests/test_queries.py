"""Every named query against its SQL text on the same files."""

import pytest

import __spark_entry__ as entry_points
from millrace.plans import QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    q = QUERIES[name]
    assert compare(spark, duck, q.build, q.oracle, sf_dir) == ""


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert not entry_points.entry(spark).isEmpty()
