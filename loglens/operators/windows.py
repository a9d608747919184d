"""Hits and last-seen time per client address, whole-table and in sliding windows.

The per-key reduce ``(count + count, max(seen))`` of the log jobs is two
algebraic aggregates, so Spark combines map-side: one hot address costs one
row per map task in the shuffle, whatever its share of the input.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglens.functions.logline import seen_text
from loglens.functions.numeric import floor_div

WINDOW_COLUMNS = ("window_start", "window_end", "ip", "hits", "last_seen")


def _hits_aggs(parsed: DataFrame):
    # With event time the maximum is over the text's fixed-width key, not the text:
    # the same answer, but a hash aggregate instead of a sort aggregate.
    last = F.max("seen_key").alias("last_key") if "seen_key" in parsed.columns else F.max("seen").alias("last_text")
    return [F.count(F.lit(1)).alias("hits"), last]


def _last_seen(agg: DataFrame):
    last = seen_text("last_key") if "last_key" in agg.columns else F.col("last_text")
    return last.alias("last_seen")


def hits_by_ip(parsed: DataFrame) -> DataFrame:
    """``ip, hits bigint, last_seen string`` over all rows."""
    agg = parsed.groupBy("ip").agg(*_hits_aggs(parsed))
    return agg.select("ip", "hits", _last_seen(agg))


def window_aggregate(parsed: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Grouped but unprojected windowed aggregate (for a stream in update mode, which allows only one stateful operator).

    Windows are aligned to the epoch and half open, ``[start, end)``; a row
    lands in ``length / slide`` windows.
    """
    w = F.window("ets", length, slide) if slide else F.window("ets", length)
    return parsed.groupBy(w.alias("window"), "ip").agg(*_hits_aggs(parsed))


def project_windows(agg: DataFrame) -> DataFrame:
    """Flatten the window struct to epoch seconds (zone-free) and fix the column order."""
    return agg.select(F.unix_seconds("window.start").alias("window_start"),
                      F.unix_seconds("window.end").alias("window_end"),
                      "ip", "hits", _last_seen(agg))


# Microseconds of the units of a window's length.
UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6,
           "day": 86400 * 10 ** 6, "week": 7 * 86400 * 10 ** 6}


def duration_us(text: str) -> int:
    """Microseconds of ``"30 seconds"`` or ``"1 day 2 hours"``; a day has 24 hours, as in Spark's windows."""
    parts = re.findall(r"(\d+)\s+([a-z]+?)s?(?:\s+|$)", text.strip().lower())
    if not parts or re.sub(r"(\d+)\s+([a-z]+)(\s+|$)", "", text.strip().lower()) or any(u not in UNIT_US for _, u in parts):
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * UNIT_US[u] for n, u in parts)


def pane_us(length: str, slide: str | None) -> int:
    """The longest span that every window is made of: the greatest common divisor of length and slide."""
    return math.gcd(duration_us(length), duration_us(slide or length))


def window_starts(pane: Column, length: str, slide: str | None) -> Column:
    """Array of the starts (epoch microseconds) of the windows that contain the pane starting at ``pane``."""
    size, step, width = duration_us(length), duration_us(slide or length), pane_us(length, slide)
    first = floor_div(pane + F.lit(width - size + step - 1), step) * F.lit(step)
    last = floor_div(pane, step) * F.lit(step)
    # A slide longer than the length leaves panes that are in no window.
    return F.when(first <= last, F.sequence(first, last, F.lit(step))).otherwise(F.array().cast("array<bigint>"))


def hits_by_pane(parsed: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """``pane bigint (epoch us), ip, hits, last_key|last_text``: rows that share all their windows, counted once."""
    width = pane_us(length, slide)
    pane = floor_div(F.unix_micros("ets"), width) * F.lit(width)
    return parsed.groupBy(pane.alias("pane"), "ip").agg(*_hits_aggs(parsed))


def hits_by_window(parsed: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """``window_start, window_end bigint (epoch s), ip, hits, last_seen``.

    Rows are not expanded to their length / slide windows: they are counted per
    client and pane (the span that divides length and slide), and the few panes are
    then combined into the windows that hold them.
    """
    panes = hits_by_pane(parsed, length, slide)
    last = "last_key" if "last_key" in panes.columns else "last_text"
    each = panes.select(F.explode(window_starts(F.col("pane"), length, slide)).alias("start"), "ip", "hits", last)
    agg = each.groupBy("start", "ip").agg(F.sum("hits").alias("hits"), F.max(last).alias(last))
    return agg.select(floor_div("start", 10 ** 6).alias("window_start"), floor_div(F.col("start") + F.lit(duration_us(length)), 10 ** 6).alias("window_end"),
                      "ip", "hits", _last_seen(agg))


def min_hits(df: DataFrame, threshold: int) -> DataFrame:
    """Groups with ``hits >= threshold`` (a HAVING filter after the aggregate)."""
    return df.where(F.col("hits") >= F.lit(threshold))


def leaderboard(windows: DataFrame, n: int = 50, by: str = "hits") -> DataFrame:
    """Top ``n`` addresses per window with a ``rank bigint`` column.

    ``by="hits"``: the busiest ``n`` (hits descending, then ip descending).
    ``by="key"``: the ``n`` greatest addresses, i.e. the natural order of a
    ``(ip, ...)`` tuple, which is what a plain ``top(n)`` picks, then ranked
    by hits (ties keep ip descending).

    ``row_number() <= n`` is planned as a WindowGroupLimit: each task keeps
    at most ``n`` rows per window before the shuffle, so a window never
    brings more than ``n`` rows per upstream partition into one task.
    """
    if by not in ("hits", "key"):
        raise ValueError(f"by must be 'hits' or 'key', not {by!r}")
    part = Window.partitionBy("window_start")
    by_hits = part.orderBy(F.desc("hits"), F.desc("ip"))
    if by == "key":
        windows = (windows.withColumn("__k", F.row_number().over(part.orderBy(F.desc("ip"))))
                          .where(F.col("__k") <= n).drop("__k"))
    ranked = windows.withColumn("rank", F.row_number().over(by_hits))
    return ranked.where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("bigint"))
