"""Access-log lines derived from the ``events`` table.

Each event becomes ``<ip> /<event_type> <yyyy_MM_dd__HH_mm_ss_SSS>``: the user
plays the client address, the event type the path and the event time the
request time.  The projection is row-local, so it keeps the scan's
partitioning and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.functions.logline import access_line
from loglens.functions.numeric import floor_div
from loglens.sources.tables import read_table


def ip_of_user(user_id) -> Column:
    """A dotted address for a numeric user id: ``10.0.<id div 256>.<id mod 256>``."""
    u = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.concat_ws(".", F.lit("10"), F.lit("0"), floor_div(u, 256).cast("string"),
                       F.pmod(u, F.lit(256)).cast("string"))


def access_log_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """``value string`` access-log lines, one per event."""
    ev = read_table(spark, data_dir, "events", "event_id", "user_id", "event_type", "ts")
    return lines_of_events(ev)


def lines_of_events(events: DataFrame) -> DataFrame:
    """``value string`` access-log lines of a table or stream of events."""
    return events.select(access_line(ip_of_user("user_id"),
                                     F.concat(F.lit("/"), F.col("event_type")),
                                     F.col("ts")).alias("value"))
