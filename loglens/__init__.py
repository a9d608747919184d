"""loglens: line-oriented text and web-access-log analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` transform built from
``pyspark.sql.functions`` so that Catalyst can push filters down, prune
columns and plan partial aggregation; the same transforms run on batch
tables and on Structured Streaming sources.
"""

import sys

from pyspark import cloudpickle

from loglens.session import build_session, materialize, staging_dir

# Ship this package's functions by value inside UDF closures, so executors
# need no install of it (``--py-files`` works as well).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "materialize", "staging_dir"]
