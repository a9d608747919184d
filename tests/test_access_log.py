import datetime as dt

import pytest

from loglens.operators import (
    access_log_rejects, hits_by_ip, hits_by_window, leaderboard, min_hits, parse_access_log,
)
from loglens.functions import format_seen
from loglens.sources import inline

BASE = dt.datetime(2024, 1, 1, 0, 0, 0)


def _seen(t: dt.datetime) -> str:
    return t.strftime("%Y_%m_%d__%H_%M_%S_") + f"{t.microsecond // 1000:03d}"


def _log(spark, rows):
    return inline(spark, [(f"{ip} /a {_seen(t)}",) for ip, t in rows], "value string")


def test_parse_fields(spark):
    df = _log(spark, [("1.2.3.4", BASE + dt.timedelta(milliseconds=7))])
    row = parse_access_log(df).first()
    assert (row.ip, row.path, row.seen) == ("1.2.3.4", "/a", "2024_01_01__00_00_00_007")
    assert row.ets.timestamp() == dt.datetime(2024, 1, 1, 0, 0, 0, 7000, tzinfo=dt.timezone.utc).timestamp()


def test_strict_mode_fails_on_short_line(spark):
    df = inline(spark, [("1.2.3.4 /a",)], "value string")
    with pytest.raises(Exception, match="fewer than 3 tokens"):
        parse_access_log(df, mode="strict").collect()


def test_permissive_mode_routes_bad_lines_to_rejects(spark):
    good = f"1.2.3.4 /a {_seen(BASE)}"
    df = inline(spark, [(good,), ("1.2.3.4 /a",), ("",), ("1.2.3.4 /a yesterday",)], "value string")
    assert parse_access_log(df).count() == 1
    rejects = {r.value: r.reason for r in access_log_rejects(df).collect()}
    assert rejects == {"1.2.3.4 /a": "fewer than 3 tokens", "": "fewer than 3 tokens",
                       "1.2.3.4 /a yesterday": "bad timestamp"}


def test_hits_and_last_seen(spark):
    rows = [("a", BASE), ("a", BASE + dt.timedelta(seconds=5)), ("b", BASE)]
    got = {r.ip: (r.hits, r.last_seen) for r in hits_by_ip(parse_access_log(_log(spark, rows))).collect()}
    assert got == {"a": (2, _seen(BASE + dt.timedelta(seconds=5))), "b": (1, _seen(BASE))}
    assert min_hits(hits_by_ip(parse_access_log(_log(spark, rows))), 2).count() == 1


def test_window_edges_are_half_open(spark):
    # one row exactly on a 10 s edge belongs to the windows starting there
    rows = [("a", BASE + dt.timedelta(seconds=10))]
    w = hits_by_window(parse_access_log(_log(spark, rows)), "30 seconds", "10 seconds")
    starts = sorted(r.window_start for r in w.collect())
    edge = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp()) + 10
    assert starts == [edge - 20, edge - 10, edge]


def test_windows_do_not_depend_on_session_time_zone(spark):
    # one of them in an hour that New York's clocks skip
    rows = [("a", BASE + dt.timedelta(hours=23, minutes=30)), ("b", dt.datetime(2024, 3, 10, 2, 30))]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            w = hits_by_window(parse_access_log(_log(spark, rows)), "1 day", "1 day")
            results.append(sorted(tuple(r) for r in w.collect()))
            ntz = inline(spark, [(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
            assert ntz.select(format_seen("t")).first()[0] == "2024_03_10__02_30_00_000"
        assert results[0] == results[1] == results[2]
        assert "2024_03_10__02_30_00_000" in {r[4] for r in results[1]}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _sixty_ips(spark):
    # 60 addresses in one 30 s window; address i has i % 7 + 1 hits
    rows = []
    for i in range(60):
        for h in range(i % 7 + 1):
            rows.append((f"10.0.0.{i:03d}", BASE + dt.timedelta(seconds=1 + h)))
    return hits_by_window(parse_access_log(_log(spark, rows)), "30 seconds", "30 seconds")


def test_top50_by_key_and_by_hits_differ(spark):
    w = _sixty_ips(spark)
    by_key = leaderboard(w, 50, by="key").collect()
    by_hits = leaderboard(w, 50, by="hits").collect()
    assert len(by_key) == len(by_hits) == 50
    key_ips = {r.ip for r in by_key}
    assert key_ips == {f"10.0.0.{i:03d}" for i in range(10, 60)}
    hits_ips = {r.ip for r in by_hits}
    assert key_ips != hits_ips
    # ranks follow hits descending, ties by ip descending
    ordered = sorted(by_hits, key=lambda r: r["rank"])
    assert [(r.hits, r.ip) for r in ordered] == sorted(((r.hits, r.ip) for r in by_hits), reverse=True)
    assert sorted(r["rank"] for r in by_key) == list(range(1, 51))


def test_last_seen_is_the_text_as_read(spark):
    df = inline(spark, [("a /x 2024_01_01__00_00_01_5",), ("a /x 2024_01_01__00_00_01_45",), ("b /x 2024_01_01__00_00_01_500",)], "value string")
    got = {r.ip: (r.hits, r.last_seen) for r in hits_by_ip(parse_access_log(df)).collect()}
    assert got == {"a": (2, "2024_01_01__00_00_01_5"), "b": (1, "2024_01_01__00_00_01_500")}


def test_arrival_time_takes_any_third_token(spark):
    df = inline(spark, [("a /x yesterday",), ("a /x 12",), ("a /x",)], "value string")
    got = [tuple(r) for r in hits_by_ip(parse_access_log(df, time="arrival")).collect()]
    assert got == [("a", 2, "yesterday")]
