"""Named queries over the shared tables and their DuckDB oracle statements."""

from loglens.plans.catalog import QUERIES
from loglens.plans.oracle import ORACLE

__all__ = ["QUERIES", "ORACLE"]
