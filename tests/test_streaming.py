"""Streams give the batch answer: small files as they arrive, restarts, late rows, batch counts."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loglens.operators import hits_by_window, leaderboard, min_hits, parse_access_log, snapshot_json
from loglens.session import staging_dir
from loglens.sources import access_log_lines, lines_of_events, stage_text
from loglens.streaming import (
    batch_count_sink, event_stream, leaderboard_sink, print_values, read_batch_counts,
    read_latest_snapshot, read_window_upserts, run_available, text_stream, to_console,
    window_upsert_sink, windowed_hits,
)


def _rows(df):
    return sorted(tuple(r) for r in df.select("window_start", "window_end", "ip", "hits",
                                              "last_seen").collect())


def _line(ip, clock):
    return f"{ip} /p 2024_01_01__{clock}_000"


class _Folder:
    """Hand-made log files, one a step, and a stream run after each."""

    def __init__(self, tmp_path):
        self.path, self.n = tmp_path / "in", 0
        self.path.mkdir()

    def add(self, *lines):
        (self.path / f"{self.n:03d}.txt").write_text("".join(f"{x}\n" for x in lines))
        self.n += 1


@pytest.fixture
def folder(tmp_path):
    return _Folder(tmp_path)


def test_table_stream_equals_batch(spark):
    root = staging_dir(spark, "t-hits")
    stream = windowed_hits(lines_of_events(event_stream(spark, SF_SMALL)), "5 days", "1 day")
    run_available(stream, window_upsert_sink(f"{root}/out", 5), f"{root}/ck", state_partitions=4)
    batch = min_hits(hits_by_window(parse_access_log(access_log_lines(spark, SF_SMALL)), "5 days", "1 day"), 5)
    assert _rows(read_window_upserts(spark, f"{root}/out")) == _rows(batch)


@pytest.mark.parametrize("store", ["rocksdb", "memory"])
def test_restarts_and_late_rows(spark, folder, store):
    root = staging_dir(spark, "t-restart")
    stream = windowed_hits(text_stream(spark, str(folder.path)), "30 seconds", "10 seconds")
    on_time = []

    def step(*lines):
        folder.add(*lines)
        run_available(stream, window_upsert_sink(f"{root}/out"), f"{root}/ck", state_partitions=2, state_store=store)

    for lines in ([_line("a", "00_00_05"), _line("b", "00_00_07")], [_line("a", "00_00_12")], [_line("a", "00_02_00")]):
        on_time += lines
        step(*lines)
    step(_line("a", "00_00_06"))  # past the watermark of 00:01:00
    want = hits_by_window(parse_access_log(spark.createDataFrame([(x,) for x in on_time], "value string")), "30 seconds", "10 seconds")
    assert _rows(read_window_upserts(spark, f"{root}/out")) == _rows(want)


def test_snapshot_never_goes_back_and_covers_a_whole_window(spark, folder):
    root = staging_dir(spark, "t-snap")
    stream = windowed_hits(text_stream(spark, str(folder.path)), "30 seconds", "10 seconds")
    seen = []
    for lines in ([_line("a", "00_00_55"), _line("a", "00_01_55"), _line("a", "00_02_00")],
                  [_line("b", "00_01_20")],               # out of order, inside the watermark
                  [_line("c", "00_03_00")], []):
        folder.add(*lines)
        run_available(stream, leaderboard_sink(f"{root}/snaps"), f"{root}/ck", output_mode="append", state_partitions=2)
        seen += [(r.window_end, json.loads(r.message)) for r in read_latest_snapshot(spark, f"{root}/snaps").collect()]
    ends = [e for e, _ in seen]
    assert ends == sorted(ends) and len(ends) >= 2
    # closed by 00:02:00 (newest event 00:03:00 less 60 s): both hits at its end are outside
    assert seen[-1][0] == 1704067200 + 120
    assert [(d["ip"], d["hits"]) for d in seen[-1][1]["data"]] == [("a", 1)]


def test_batch_snapshot_takes_the_newest_closed_window(spark):
    lines = [_line("a", "00_01_40"), _line("a", "00_01_55"), _line("a", "00_02_00")]
    parsed = parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    board = leaderboard(hits_by_window(parsed, "30 seconds", "10 seconds"))
    newest = parsed.agg(F.unix_micros(F.max("ets")).alias("n"))
    row = snapshot_json(board, newest).first()
    assert row.window_end == 1704067200 + 120
    assert [d["hits"] for d in json.loads(row.message)["data"]] == [2]
    assert snapshot_json(board, newest, delay_us=3_600_000_000).count() == 0


def test_batch_counts_one_file_a_batch_and_empty_ones(spark, folder):
    root = staging_dir(spark, "t-count")
    for lines in (["x", "y"], [], ["z"]):
        folder.add(*lines)
        run_available(text_stream(spark, str(folder.path), 1), batch_count_sink(f"{root}/out"), f"{root}/ck", output_mode="append")
    got = sorted(tuple(r) for r in read_batch_counts(spark, f"{root}/out").collect())
    assert got == [(0, 2, "received 2 events"), (1, 0, "received 0 events"), (2, 1, "received 1 events")]


def test_arrival_time_mode_counts_every_line(spark, folder):
    folder.add("a /x yesterday", _line("a", "00_00_01"))
    root = staging_dir(spark, "t-arrival")
    stream = windowed_hits(text_stream(spark, str(folder.path)), "1 hour", "1 hour", watermark=None, time="arrival")
    run_available(stream, window_upsert_sink(f"{root}/out"), f"{root}/ck", state_partitions=2)
    got = read_window_upserts(spark, f"{root}/out").agg(F.sum("hits"), F.max("last_seen")).first()
    assert tuple(got) == (2, "yesterday")


def test_console_consumer_prints_every_value(spark, folder, capsys):
    folder.add(*[f"v{i}" for i in range(60)])
    run_available(text_stream(spark, str(folder.path)), print_values(), staging_dir(spark, "t-print"), output_mode="append")
    assert set(capsys.readouterr().out.split()) >= {f"v{i}" for i in range(60)}


def test_console_sink_runs(spark):
    folder = stage_text(access_log_lines(spark, SF_SMALL), name="console")
    q = to_console(text_stream(spark, folder), num_rows=3, checkpoint=staging_dir(spark, "console-ckpt"))
    q.awaitTermination(120)
    assert not q.isActive and q.exception() is None


def test_processing_time_trigger(spark, folder):
    folder.add("x")
    q = to_console(text_stream(spark, str(folder.path)), num_rows=2, processing_time="1 second",
                   checkpoint=staging_dir(spark, "interval-ckpt"))
    try:
        q.processAllAvailable()
        assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) == 1
    finally:
        q.stop()
