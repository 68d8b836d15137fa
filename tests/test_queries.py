"""Each registered query against its SQL, or, without SQL, that it has rows and repeats them."""

import pytest

import quarry.plans  # noqa: F401
from quarry.plans.registry import QUERIES, SQL

from .oracle import assert_same, canonical, connect


@pytest.fixture(scope="module")
def con(tables):
    return connect(tables)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, tables, con, name):
    assert_same(QUERIES[name](spark, tables), con.sql(SQL[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs_without_sql(spark, tables, name):
    """It has rows, the same ones each time."""
    frame = QUERIES[name](spark, tables)
    first, again = (sorted(canonical(tuple(r[n] for n in sorted(frame.columns))) for r in f.collect()) for f in (frame, QUERIES[name](spark, tables)))
    assert first and first == again


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
