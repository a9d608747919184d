from pyspark.sql import functions as F

from loglens.operators import (
    agent_keywords, agents_of, distinct_keywords, keyword_freq, min_hits, top_keywords,
)
from loglens.sources import inline


def _dashboard(spark):
    # FIXTURES §5
    rows = [("10.0.0.1", 12, ["Mozilla/5.0 (Linux; Android)", "curl/7.1"]),
            ("10.0.0.2", 9, ["Mozilla/5.0 (Windows)"])]
    df = inline(spark, rows, "ip string, hits bigint, agents array<string>")
    return df, df.select("ip", "hits", F.explode("agents").alias("agent"))


def test_keyword_frequencies(spark):
    _, agents = _dashboard(spark)
    freq = {r.keyword: r.freq for r in keyword_freq(agent_keywords(agents, "ip", "agent")).collect()}
    assert freq == {"mozilla": 2, "linux": 1, "android": 1, "curl": 1, "windows": 1}


def test_distinct_and_top_keywords(spark):
    _, agents = _dashboard(spark)
    kw = agent_keywords(agents, "ip", "agent")
    pairs = {(r.ip, r.keyword) for r in distinct_keywords(kw, "ip").collect()}
    assert ("10.0.0.1", "mozilla") in pairs and len(pairs) == 6
    top = top_keywords(kw, "ip", 50)
    first = [r.keyword for r in top.where("ip = '10.0.0.1'").orderBy("rank").collect()]
    assert first == ["mozilla", "android", "curl", "linux"]
    top2 = [r.keyword for r in top_keywords(kw, "ip", 2).where("ip = '10.0.0.1'").orderBy("rank").collect()]
    assert top2 == ["mozilla", "android"]


def test_threshold_shows_only_busy_ips_but_all_count(spark):
    dash, agents = _dashboard(spark)
    shown = min_hits(dash, 10).select("ip").collect()
    assert [r.ip for r in shown] == ["10.0.0.1"]
    freq = {r.keyword: r.freq for r in keyword_freq(agent_keywords(agents, "ip", "agent")).collect()}
    assert freq["mozilla"] == 2


def test_agents_of_one_ip_sorted(spark):
    _, agents = _dashboard(spark)
    got = [r.agent for r in agents_of(agents, "ip", "agent", "10.0.0.1").collect()]
    assert got == ["Mozilla/5.0 (Linux; Android)", "curl/7.1"]
