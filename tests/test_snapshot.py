import json

from loglens.operators import leaderboard, newest_window, snapshot_json
from loglens.sources import inline


def test_snapshot_is_newest_window_in_rank_order(spark):
    rows = [(0, 30, "a", 5, "t1"), (0, 30, "b", 7, "t2"),
            (10, 40, "a", 2, "t3"), (10, 40, "c", 9, "t4"), (10, 40, "b", 9, "t5")]
    w = inline(spark, rows, "window_start bigint, window_end bigint, ip string, hits bigint, last_seen string")
    board = leaderboard(w, 50)
    assert {r.window_end for r in newest_window(board).collect()} == {40}
    row = snapshot_json(board).first()
    msg = json.loads(row.message)
    assert row.window_end == 40
    assert msg["id"] == "40" and msg["key"] == "dataPush"
    assert [(d["ip"], d["hits"]) for d in msg["data"]] == [("c", 9), ("b", 9), ("a", 2)]
