"""Parse access-log lines ``<ip> <path> <yyyy_MM_dd__HH_mm_ss_SSS>``.

Two modes: ``strict`` fails the job on a line with fewer than three tokens,
as an index-out-of-bounds would (and, with event time, on a time it cannot
read); ``permissive`` keeps good lines and sends
the rest to :func:`access_log_rejects`.  ``time="event"`` (default) reads the
event time from the line, ``time="arrival"`` stamps each row with the time
it is processed, as a receiver-based stream does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions.logline import LOG_TS_PATTERN, seen_key, try_parse_seen
from loglens.functions.text import java_split
from loglens.operators.filters import where_computed

PARSED_COLUMNS = ("ip", "path", "seen", "ets", "seen_key")


def _tokens(column: str) -> Column:
    return java_split(column, " ")


def _reason(tokens: Column, ets: Column) -> Column:
    return (F.when(F.size(tokens) < 3, F.lit("fewer than 3 tokens"))
             .when(ets.isNull(), F.lit("bad timestamp")))


def parse_access_log(lines: DataFrame, column: str = "value", mode: str = "permissive",
                     time: str = "event") -> DataFrame:
    """``ip, path, seen string, ets timestamp`` and, with event time, ``seen_key bigint`` per line.

    ``seen`` is the raw third token and ``ets`` the instant used for windows
    (event or arrival time).  The time is parsed once per row; ``seen_key``
    sorts as the text does and gives ``last_seen`` back exactly as read.  With
    arrival time any third token is kept, and ``last_seen`` is the greatest text.
    Row-local: no shuffle, and the projection is pushed into the scan's
    column list.
    """
    if mode not in ("permissive", "strict"):
        raise ValueError(f"mode must be 'permissive' or 'strict', not {mode!r}")
    if time not in ("event", "arrival"):
        raise ValueError(f"time must be 'event' or 'arrival', not {time!r}")
    tok = lines.select(_tokens(column).alias("__t"))
    third = F.get("__t", 2)
    if mode == "strict":
        third = F.when(F.size("__t") < 3, F.raise_error(F.concat(
            F.lit("access-log line has fewer than 3 tokens: "),
            F.array_join("__t", " ")))).otherwise(third)
    parsed = tok.select(F.get("__t", 0).alias("ip"), F.get("__t", 1).alias("path"), third.alias("seen"))
    if time == "arrival":
        if mode == "permissive":
            parsed = parsed.where(F.col("seen").isNotNull())
        return parsed.select("ip", "path", "seen", F.current_timestamp().alias("ets"))
    parsed = parsed.withColumn("ets", try_parse_seen("seen"))
    if mode == "strict":
        bad = F.raise_error(F.concat(F.lit("access-log time is not "), F.lit(LOG_TS_PATTERN),
                                     F.lit(": "), F.coalesce("seen", F.lit("NULL"))))
        parsed = parsed.withColumn("ets", F.coalesce("ets", bad.cast("timestamp")))
    else:
        # A missing third token gives a NULL time, so one check covers both.
        parsed = where_computed(parsed.withColumn("__ok", F.col("ets").isNotNull()), "__ok")
    return parsed.select("ip", "path", "seen", "ets", seen_key("seen", "ets").alias("seen_key"))


def access_log_rejects(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines :func:`parse_access_log` would drop: ``value string, reason string``."""
    tok = lines.select(F.col(column).alias("value"), _tokens(column).alias("__t"))
    ets = F.when(F.size("__t") >= 3, try_parse_seen(F.get("__t", 2)))
    reasons = tok.select("value", _reason(F.col("__t"), ets).alias("reason"))
    return where_computed(reasons.withColumn("__bad", F.col("reason").isNotNull()), "__bad")
