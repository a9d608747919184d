"""Keyed stream state: pane windows and late rows, latest-wins values, timed pushes."""

import json

import pytest
from pyspark.sql import functions as F

from loglens.operators import hits_by_window, parse_access_log
from loglens.operators.windows import duration_us, pane_us
from loglens.session import staging_dir
from loglens.streaming import (
    PANE_ROWS, closed_windows, late_rows, latest_wins, leaderboard_sink, newest_push, pane_windows, push_for, read_latest,
    read_latest_snapshot, read_open_windows, read_pushes, run_available, run_to_files, snapshot_stream, text_stream, windowed_hits,
)

BASE = 1704067200  # 2024-01-01


def _line(ip, clock):
    return f"{ip} /p 2024_01_01__{clock}_000"


def _want(spark, lines, length, slide):
    df = hits_by_window(parse_access_log(spark.createDataFrame([(x,) for x in lines], "value string")), length, slide)
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("length, slide", [("30 seconds", "10 seconds"), ("30 seconds", "20 seconds")])
def test_windows_and_late_rows_are_all_rows(spark, tmp_path, length, slide):
    root, folder = staging_dir(spark, "t-panes"), tmp_path / "in"
    folder.mkdir()
    stream = pane_windows(text_stream(spark, str(folder)), length, slide)
    steps = [[_line("a", "00_00_05"), _line("b", "00_00_07"), _line("a", "00_00_05")], [_line("a", "00_00_12")], [_line("a", "00_02_00"), _line("c", "00_01_55")],
             [_line("a", "00_00_06"), _line("c", "00_00_06"), _line("b", "00_00_50"), "broken"], [_line("b", "00_09_00")]]
    for k, lines in enumerate(steps):
        (folder / f"{k}.txt").write_text("".join(f"{x}\n" for x in lines))
        run_to_files(stream, f"{root}/out", f"{root}/ck", state_partitions=2)  # a restart on one checkpoint every time
    rows = spark.read.schema(PANE_ROWS).parquet(f"{root}/out")
    got = closed_windows(rows, length).unionByName(read_open_windows(spark, f"{root}/ck", length, slide))
    got = {(r.window_start, r.ip): r.hits for r in got.collect()}
    every = [x for s in steps for x in s if x != "broken"]
    # b at 00:00:50 comes when the watermark is at 00:01:00: some windows still take it
    all_hits = {(w, ip): hits for w, _, ip, hits, _ in _want(spark, every, length, slide)}
    late = late_rows(rows).collect()
    assert {r.ip for r in late} >= {"a", "c"} and all(r.missed > 0 for r in late)
    assert sum(got.values()) + sum(r.hits * r.missed for r in late) == sum(all_hits.values())
    for key, hits in got.items():
        assert hits <= all_hits[key]
    on_time = [x for k, s in enumerate(steps) if k != 3 for x in s]
    for w, _, ip, hits, _ in _want(spark, on_time, length, slide):
        assert got[(w, ip)] >= hits


def test_state_holds_panes_only_until_their_last_window(spark, tmp_path):
    root, folder = staging_dir(spark, "t-state"), tmp_path / "in"
    folder.mkdir()
    (folder / "0.txt").write_text("".join(_line("a", f"00_{m:02d}_{s:02d}") + "\n" for m in range(10) for s in range(0, 60, 5)))
    run_to_files(pane_windows(text_stream(spark, str(folder)), "30 seconds", "10 seconds"), f"{root}/out", f"{root}/ck", state_partitions=1)
    state = spark.read.format("statestore").option("path", f"{root}/ck").option("stateVarName", "panes").load()
    held = state.select(F.size("value.panes")).first()[0]
    assert held <= (60 + 30) // 10 + 1  # what the watermark waits for, and one window


def test_latest_wins_costs_only_the_batch_and_survives_a_restart(spark, tmp_path):
    root, folder = staging_dir(spark, "t-latest"), tmp_path / "in"
    folder.mkdir()
    schema = "k string, version bigint, v string"
    rows = spark.readStream.schema(schema).csv(str(folder))
    stream = latest_wins(rows, "k", "version", "v")
    for n, lines in enumerate((["a,1,x", "a,3,y", "b,9007199254740993,p"], ["a,2,late", "b,9007199254740992,q", "c,,n", ",1,n"], ["c,5,z", "a,3,zz"])):
        (folder / f"{n}.csv").write_text("".join(f"{x}\n" for x in lines))
        run_to_files(stream, "", f"{root}/ck", "update", state_partitions=2)
    assert sorted(tuple(r) for r in read_latest(spark, f"{root}/ck").collect()) == [("a", 3, "zz"), ("b", 9007199254740993, "p"), ("c", 5, "z")]


def test_latest_wins_with_time_to_live(spark, tmp_path):
    root, folder = staging_dir(spark, "t-ttl"), tmp_path / "in"
    folder.mkdir()
    (folder / "0.csv").write_text("a,1,x\n")
    stream = latest_wins(spark.readStream.schema("k string, version bigint, v string").csv(str(folder)), "k", "version", "v", ttl_ms=600_000)
    # such a stream never runs dry: it is stopped
    push_for(stream, "", f"{root}/ck", 60, lambda: _stored(spark, f"{root}/ck"), output_mode="update")
    assert [tuple(r) for r in read_latest(spark, f"{root}/ck").collect()] == [("a", 1, "x")]


def _stored(spark, checkpoint):
    try:
        return read_latest(spark, checkpoint).count() == 1
    except Exception:  # no committed batch yet
        return False


def test_two_windows_in_an_interval_give_one_message(spark):
    root = staging_dir(spark, "t-push")
    snaps = f"{root}/snaps"

    def write(n, end):
        spark.createDataFrame([(end, json.dumps({"id": str(end)}))], "window_end bigint, message string").write.parquet(f"{snaps}/batch_id={n}")

    write(0, 20)
    write(1, 30)
    stream = newest_push(snapshot_stream(spark, snaps), 500)
    seen = lambda n: lambda: read_pushes(spark, f"{root}/out").count() >= n
    push_for(stream, f"{root}/out", f"{root}/ck", 90, seen(1))
    assert [r.window_end for r in read_pushes(spark, f"{root}/out").collect()] == [30]
    write(2, 10)   # older than what was pushed
    write(3, 40)
    push_for(stream, f"{root}/out", f"{root}/ck", 90, seen(2))
    assert sorted(r.window_end for r in read_pushes(spark, f"{root}/out").collect()) == [30, 40]


def test_nothing_closed_gives_no_rows_and_no_error(spark, tmp_path):
    root, folder = staging_dir(spark, "t-none"), tmp_path / "in"
    folder.mkdir()
    (folder / "0.txt").write_text(_line("a", "00_00_05") + "\n")
    run_available(windowed_hits(text_stream(spark, str(folder)), "30 seconds", "10 seconds"), leaderboard_sink(f"{root}/snaps"), f"{root}/ck", output_mode="append", state_partitions=1)
    assert read_latest_snapshot(spark, f"{root}/snaps").collect() == []
    push_for(newest_push(snapshot_stream(spark, f"{root}/snaps"), 100), f"{root}/out", f"{root}/push", 5)
    assert read_pushes(spark, f"{root}/out").collect() == []


def test_durations():
    assert duration_us("30 seconds") == 30_000_000 and duration_us("1 day 2 hours") == 26 * 3600 * 10 ** 6 and duration_us("1 week") == 7 * duration_us("1 day")
    assert pane_us("5 days", "2 days") == duration_us("1 day")
    for bad in ("", "3", "2 moons", "days 3", "1 day x"):
        with pytest.raises(ValueError):
            duration_us(bad)


@pytest.mark.parametrize("length, slide", [("7 seconds", "3 seconds"), ("2 seconds", "5 seconds"), ("10 seconds", None)])
def test_panes_of_odd_windows(spark, length, slide):
    lines = [_line("a", f"00_00_{s:02d}") for s in (0, 1, 4, 5, 6, 9, 13, 14, 59)]
    step = duration_us(slide or length) // 10 ** 6
    size = duration_us(length) // 10 ** 6
    want = {}
    for s in (0, 1, 4, 5, 6, 9, 13, 14, 59):
        t = BASE + s
        start = t // step * step
        while start + size > t:
            want[start] = want.get(start, 0) + 1
            start -= step
    assert {w: h for w, _, _, h, _ in _want(spark, lines, length, slide)} == want
