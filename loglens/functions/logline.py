"""Access-log line format: ``<ip> <path> <yyyy_MM_dd__HH_mm_ss_SSS>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglens.functions.numeric import floor_div

# Fixed value: the timestamp layout of an access-log line.  It is zero padded
# and fixed width, so the lexicographic maximum is the latest time.
LOG_TS_PATTERN = "yyyy_MM_dd__HH_mm_ss_SSS"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_seen(ts) -> Column:
    """Render a ``timestamp_ntz`` in the log layout: its own wall clock, whatever the session time zone."""
    text = _col(ts).cast("string")  # yyyy-MM-dd HH:mm:ss[.f...], zone-free for an NTZ value
    return F.concat(F.translate(F.substring(text, 1, 10), "-", "_"), F.lit("__"), F.translate(F.substring(text, 12, 8), ":", "_"),
                    F.lit("_"), F.rpad(F.substring(text, 21, 3), 3, "0"))


def try_parse_seen(seen) -> Column:
    """Parse the log layout as UTC into an absolute ``timestamp``; NULL for other text.

    The explicit ``+0000`` makes the result independent of the session time
    zone, so window boundaries are the same on every cluster.
    """
    return F.try_to_timestamp(F.concat(_col(seen), F.lit("+0000")), F.lit(LOG_TS_PATTERN + "Z"))


def seen_key(seen, ets) -> Column:
    """A bigint that sorts as the log text does, from the text and its parsed time.

    Epoch microseconds and the number of fraction digits: fixed width, so its
    maximum is a hash aggregate, zone-free, and :func:`seen_text` gives back
    exactly the text that was read, also one with a short fraction.
    """
    digits = F.length(F.substring_index(_col(seen), "_", -1))
    return F.unix_micros(_col(ets)) * F.lit(16) + digits


def seen_text(key) -> Column:
    """The log text of a :func:`seen_key`."""
    seconds = floor_div(_col(key), 16).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")
    ts = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.substring(format_seen(ts), F.lit(1), F.lit(21) + F.pmod(_col(key), F.lit(16)).cast("int"))


def access_line(ip, path, ts) -> Column:
    """Assemble one access-log line from its three parts."""
    return F.concat_ws(" ", _col(ip), _col(path), format_seen(ts))
