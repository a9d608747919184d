"""Gap filling and concatenation over range partitions."""

import random

from pyspark.sql import functions as F

from loglens.operators import concat_offsets, concat_pieces, counts, tumbling_counts


def test_pieces_laid_by_offset_are_the_whole(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, "", "é", "abc", "x" * r.randint(1, 300)])) for i in range(2000)]
    df = spark.createDataFrame(rows, "at bigint, v string").repartition(9)
    whole = "".join(v or "" for _, v in rows).encode()
    laid = bytearray(len(whole))
    pieces = concat_pieces(df, "v", "at", 1000).collect()
    for p in pieces:
        b = p.text.encode()
        laid[p.offset:p.offset + len(b)] = b
        assert len(b) <= 1300
    assert bytes(laid) == whole and len(pieces) > 20
    assert sum(len(p.text.encode()) for p in pieces) == len(whole)
    assert concat_offsets(df.where("false"), "v", "at").collect() == []
    assert concat_pieces(df.where("v is null"), "v", "at").collect() == []


def test_gaps_are_filled_across_parts_and_spans(spark, monkeypatch):
    monkeypatch.setattr(counts, "SPAN", 7)
    seconds = [5, 5, 61, 62, 600, 60 * 40, None, -130]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts")).repartition(5)
        got = sorted((tuple(r) for r in tumbling_counts(df, "ts", 60).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    finally:
        spark.conf.unset("spark.sql.session.timeZone")
    busy = {}
    for s in seconds:
        busy[None if s is None else s // 60 * 60] = busy.get(None if s is None else s // 60 * 60, 0) + 1
    want = [(None, 1, "received 1 events")] + [(w, busy.get(w, 0), f"received {busy.get(w, 0)} events") for w in range(-180, 2401, 60)]
    assert got == want
    assert tumbling_counts(df.where("false"), "ts", 60).collect() == []
