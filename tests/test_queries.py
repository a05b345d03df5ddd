"""Every registered query against its SQL, on the smallest test data."""

import os

import pytest

from compare import connect, difference

import __spark_entry__ as entry_points
from salesmart.queries import SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_registry():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


# The text queries, where present, are compared with theirs by their own tests.
@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    assert difference(frame, con, entry_points.oracle_sql()[name]) is None


def test_approximate_cardinality(spark):
    """The sketch is close to the exact count."""
    exact = {r.column_name: r.n_distinct for r in entry_points.queries()["cardinality"](spark, SF_DIR).collect()}
    for row in entry_points.queries()["cardinality_approx"](spark, SF_DIR).collect():
        assert abs(row.n_distinct - exact[row.column_name]) <= 0.1 * exact[row.column_name] + 1
