"""Structured Streaming jobs and idempotent ``foreachBatch`` sinks."""

from loglens.streaming.jobs import (
    text_stream, socket_stream, event_stream, to_console, windowed_hits, run_available, run_to_files, push_for,
)
from loglens.streaming.sinks import (
    window_upsert_sink, read_window_upserts, leaderboard_sink, read_latest_snapshot,
    batch_count_sink, read_batch_counts, print_values, snapshot_stream, read_pushes,
)
from loglens.streaming.state import (
    PANE_ROWS, closed_windows, late_rows, latest_wins, newest_push, pane_windows, read_latest, read_open_windows,
)

__all__ = [name for name in dir() if not name.startswith("_")]
