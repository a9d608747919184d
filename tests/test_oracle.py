"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from oracle_compare import compare, duck_connection

from loglens.plans import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), duck, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "ip", "hits", "last_seen"]
    assert df.count() > 0
