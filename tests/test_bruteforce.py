"""Skewed fixtures (one key holds a third of the rows) against pandas brute force."""

import datetime as dt
import random
import re

import pandas as pd

from loglens.operators import (
    agent_keywords, hits_by_window, leaderboard, parse_access_log, top_keywords,
)
from loglens.sources import inline

BASE = dt.datetime(2024, 3, 1)


def _seen(t):
    return t.strftime("%Y_%m_%d__%H_%M_%S_") + f"{t.microsecond // 1000:03d}"


def _skewed_log(n=6000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ip = "10.0.0.1" if i % 3 == 0 else f"10.0.{rnd.randint(0, 3)}.{rnd.randint(0, 60)}"
        t = BASE + dt.timedelta(seconds=rnd.randint(0, 5 * 86400), milliseconds=rnd.randint(0, 999))
        rows.append((ip, t))
    return rows


def _brute_windows(rows, length_s, slide_s):
    out = {}
    for ip, t in rows:
        es = int((t - dt.datetime(1970, 1, 1)).total_seconds())
        last = es - es % slide_s
        for k in range(length_s // slide_s):
            ws = last - k * slide_s
            hits, seen = out.get((ws, ip), (0, ""))
            out[(ws, ip)] = (hits + 1, max(seen, _seen(t)))
    return out


def test_windows_and_leaderboards_under_skew(spark):
    rows = _skewed_log()
    log = inline(spark, [(f"{ip} /x {_seen(t)}",) for ip, t in rows], "value string").repartition(8)
    w = hits_by_window(parse_access_log(log), "1 day", "6 hours")
    got = {(r.window_start, r.ip): (r.hits, r.last_seen) for r in w.collect()}
    assert got == _brute_windows(rows, 86400, 6 * 3600)

    df = pd.DataFrame([(ws, ip, h) for (ws, ip), (h, _) in got.items()],
                      columns=["ws", "ip", "hits"])
    for by in ("hits", "key"):
        board = leaderboard(w, 10, by=by).collect()
        expect = set()
        for ws, g in df.groupby("ws"):
            if by == "key":
                g = g.sort_values("ip", ascending=False).head(10)
            top = g.sort_values(["hits", "ip"], ascending=[False, False]).head(10)
            expect |= {(ws, ip, rank + 1) for rank, ip in enumerate(top["ip"])}
        assert {(r.window_start, r.ip, r["rank"]) for r in board} == expect, by


def test_top_keywords_under_skew(spark):
    rnd = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    docs = []
    for d in range(300):
        # one client owns a third of all agents; "alpha" is in every agent
        client = 0 if d % 3 == 0 else d
        agent = " ".join(["alpha"] + rnd.sample(words, 3)) + f"/{d}.0 (x; y)"
        docs.append((client, agent))
    df = inline(spark, docs, "client bigint, agent string").repartition(4)
    got = {(r.client, r.keyword): (r.freq, r["rank"])
           for r in top_keywords(agent_keywords(df, "client", "agent"), "client", 3).collect()}

    occ = [(c, tok.lower()) for c, a in docs for tok in re.split(r"[ /,;()]", a)
           if tok and not re.search(r"[0-9._-]+", tok)]
    freq = pd.Series([k for _, k in occ]).value_counts()
    expect = {}
    for c in {c for c, _ in occ}:
        kws = sorted({k for cc, k in occ if cc == c}, key=lambda k: (-freq[k], k))[:3]
        for i, k in enumerate(kws):
            expect[(c, k)] = (int(freq[k]), i + 1)
    assert got == expect
