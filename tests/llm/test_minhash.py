"""Near-duplicate groups against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from loglens.llm import minhash
from loglens.llm.text import Words, combine, shingles
from llm_brute import _set, brute

def _rows():
    random.seed(3)
    word = lambda: "".join(random.choice("abcdeé") for _ in range(random.randint(1, 5)))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(random.randint(30, 120))]
        for _ in range(random.randint(1, 9)):
            copy = list(base)
            for _ in range(random.randint(0, 6)):
                copy[random.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy)))
            n += 3
    text = rows[0][1]
    return rows + [(1, None), (2, ""), (4, " \n\t "), (5, "one two"), (7, "ONE  two"), (8, "one"), (10, text.upper()), (10, text.upper()), (None, text), (13, text.replace(" ", "\x0b\r\n"))]


@pytest.mark.parametrize("width, block, rounds", [(4, 256, 2), (5, 3, 0)])
def test_groups_equal_brute_force(spark, width, block, rounds):
    rows = _rows()
    docs = spark.createDataFrame([(d, t, b"x", 1) for d, t in rows], "doc_id bigint, text string, digest binary, band int").repartition(3)
    got = minhash.near_duplicates(docs, width, block=block, rounds=rounds).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, width, 80)


def test_drop_keeps_one_of_each_group_and_all_columns(spark):
    rows = _rows()
    docs = spark.createDataFrame([(d, t, "en", "kept") for d, t in rows], "doc_id bigint, text string, lang string, kept string")
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    want = sorted({(d, t) for (d, t), b in zip(sorted(rows, key=lambda r: repr(r[0])), sorted(brute(rows, 5, 80))) if b[3]}, key=repr)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.near_duplicates(none).count() == 0


def test_signature_values_estimate_the_similarity():
    random.seed(1)
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"v{i}" for i in range(100)])
    flat, off = shingles(Words(pa.array([a, b])), 4)
    v = minhash._extremes(flat, off, 2000)
    x, y = _set(a, 4), _set(b, 4)
    assert abs((v[0] == v[1]).mean() - len(x & y) / len(x | y)) < 0.03


def test_shingle_hashes_do_not_depend_on_the_batch():
    texts = ["a b c d e", "", "x " * 5000 + "é", None, "q"]
    flat, off = shingles(Words(pa.array(texts)), 4)
    for k, t in enumerate(texts):
        own, _ = shingles(Words(pa.array([t], pa.string())), 4)
        assert (flat[off[k]:off[k + 1]] == own).all()
        assert len(own) == len(_set(t, 4))
    assert len(combine(np.empty(0, np.uint64), 3)) == 0
