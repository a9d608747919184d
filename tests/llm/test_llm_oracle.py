"""Every registered query of the subpackage that SQL can express against its DuckDB twin."""

import pytest

from conftest import SF_ORACLE
from loglens.llm.queries import ORACLE, QUERIES
from oracle_compare import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), duck, ORACLE[name])
    assert ok, msg


def test_names_and_entry():
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES)
