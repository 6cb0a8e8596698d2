"""Every registered query of the main library against its SQL, and its shape where SQL has none."""

import pytest

from spanloom import queries
from tests import oracle


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connection(sf)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, sf, con, name):
    oracle.same(con, queries.ORACLE_SQL[name], queries.QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert queries.QUERIES[name](spark, sf).count() > 0


def test_entry(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
