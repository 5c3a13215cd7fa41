"""Every query with oracle SQL matches DuckDB on the smallest tables; model
queries run and return rows."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as E

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, _, detail = compare(spark, con, SF_SMALL, name, QUERIES[name], SQL[name])
    assert ok, detail


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_query_names_follow_naming_rules():
    """The library's own queries leave the corpus operators' names alone."""
    import re

    from dwellrec.plans import catalog
    for name in catalog.QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)
