"""JSON snapshot of the newest window of a leaderboard (the dashboard push)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the message key the dashboard listens for.
PUSH_KEY = "dataPush"


def newest_window(board: DataFrame, newest: DataFrame | None = None, delay_us: int = 0) -> DataFrame:
    """Rows of the newest closed window: the greatest ``window_end`` at most ``delay_us`` before the newest event.

    ``newest`` has one row, the newest event time in epoch microseconds: a
    sliding window that ends after it still lacks rows.  Without ``newest``
    all windows of ``board`` count as closed (a stream's append mode emits
    only such ones).  Both bounds are scalar subqueries of the same query.
    """
    if newest is not None:
        board = board.where(F.col("window_end") * F.lit(1000000) <= newest.scalar() - F.lit(delay_us))
    return board.where(F.col("window_end") == board.agg(F.max("window_end").alias("m")).scalar())


def snapshot_json(board: DataFrame, newest: DataFrame | None = None, delay_us: int = 0) -> DataFrame:
    """``window_end bigint, message string``: ``{"id","key","data":[{ip,hits,last_seen}]}``.

    ``data`` follows ``rank``.  ``board`` must be ranked: a leaderboard window
    has at most ``n`` rows, so collecting one window into a message is bounded.
    The id is the window end (stable on replay) rather than a clock reading.
    """
    if "rank" not in board.columns:
        raise ValueError("a snapshot needs a ranked board, whose windows are bounded")
    return snapshot_message(newest_window(board, newest, delay_us))


def snapshot_message(rows: DataFrame) -> DataFrame:
    """JSON message per ``window_end`` of leaderboard ``rows`` (``data`` in rank order)."""
    msg = rows.groupBy("window_end").agg(
        F.sort_array(F.collect_list(F.struct("rank", "ip", "hits", "last_seen"))).alias("__rows"))
    data = F.transform("__rows", lambda r: F.struct(r["ip"].alias("ip"), r["hits"].alias("hits"),
                                                    r["last_seen"].alias("last_seen")))
    body = F.struct(F.col("window_end").cast("string").alias("id"),
                    F.lit(PUSH_KEY).alias("key"), data.alias("data"))
    return msg.select("window_end", F.to_json(body).alias("message"))
