"""The prefix trie against a trie built in plain Python; the sketch against exact counts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglens.llm import prefix_trie as T
from loglens.llm import sketch

SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, hi int, length int, one string"


def trie(convs):
    """{(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends)} of {id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += not kids[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def ordered(rows):
    """{id: [(role, text)]}; the rows' turns differ within an id, or their texts are equal."""
    out = defaultdict(list)
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        out[c].append((r or "", x or ""))
    return dict(out)


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA).repartition(5)


def plain_trie(spark, rows, bits=None):
    own = T.numbered(T.compact(frame(spark, rows)))
    return sorted((tuple(r) for r in T.prefix_trie(own, T.lengths(own), bits).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    out = []
    for c in range(1, 140):
        if c == 60:
            continue  # an absent donor
        n = r.choice([1, 1, 2, 3, 5, 8])
        start = r.choice([0, 0, 0, 1])
        out += [(c, k, r.choice(["user", "user", "assistant", None]), r.choice(["a b", "a b", "a  b\tc", "", None, f"own {c}"])) for k in range(start, start + n)]
    for c in range(200, 260):                      # a hot group of copies, and a hot first turn
        out += [(c, k, "user", f"copied text {k}") for k in range(4)] + ([(c, 4, "user", f"last {c}")] if c > 240 else [])
    out += [(20, None, "system", "null turn first"), (300, 1, "user", "same"), (300, 1, "user", "same"), (None, 0, "user", "no id")]
    out += [(400, k, "user", "again") for k in range(700)]  # a hot conversation
    out += [(401, k, "user", "again") for k in range(650)]
    return out


def test_trie_equals_brute_force(spark, rows):
    want = trie(ordered(rows))
    assert plain_trie(spark, rows) == want
    assert plain_trie(spark, rows, bits=sketch.BLOCK_BITS) == want


def test_small_parts(spark, rows):
    """Conversations over several parts and Arrow batches."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert plain_trie(spark, rows) == trie(ordered(rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_spliced_equals_brute_force(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in T.q_op12(spark, str(tmp_path)).collect()), key=repr)
    assert got == trie(rebuilt(ordered(rows)))


@pytest.mark.parametrize("some", [[], [(None, 0, "user", "x")]])
def test_no_conversation_no_node(spark, some):
    assert plain_trie(spark, some) == []


def test_one_conversation(spark):
    assert plain_trie(spark, [(7, 0, None, None)]) == trie({7: [("", "")]})


def test_sketch_never_underestimates(spark):
    r = np.random.default_rng(2)
    keys = r.integers(-2 ** 62, 2 ** 62, 3000)
    df = spark.createDataFrame([(int(k),) for k in [*keys, *keys[:500], *keys[:100], *[5] * 2000]], "k bigint").repartition(6)
    found = sketch.build(df, "k", 16)
    assert found.met(keys.view(np.uint64)).all()
    assert found.met_twice(keys[:500].view(np.uint64)).all() and found.met_twice(np.array([5], np.uint64)).all()
    assert found.met_twice(keys[500:].view(np.uint64)).mean() < 0.05
    assert found.met(r.integers(0, 2 ** 62, 3000).view(np.uint64)).mean() < 0.05


def test_long_lists_are_hashed_in_order(spark, monkeypatch):
    ids = random.Random(1).sample(range(-10 ** 6, 10 ** 12), 5000)
    df = spark.createDataFrame([(1, 2, 3, i) for i in ids] + [(1, 2, 4, 9)], "hi bigint, lo bigint, depth bigint, conv_id bigint").repartition(9)
    got = {r["depth"]: r["ends_sha256"] for r in T.list_digests(df).collect()}
    assert got == {3: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), 4: hashlib.sha256(b"9").hexdigest()}
