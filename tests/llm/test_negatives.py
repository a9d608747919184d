"""Hard negatives by slots against a search of every window on its own."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglens.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, grp int, score string, id string, q int"


def brute(rows, every=5, n_pos=5, n_neg=5, low=80, high=100, scale=256):
    """{(anchor, positive, rank, negative, positive score, negative score)} by definition; rows of (id, vector, label)."""
    good = {(i, tuple(math.floor(scale * x) for x in v), y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, v, y in sorted(good):
        if i % every:
            continue
        same = sorted({(-dot(v, w), j) for j, w, z in good if z == y and j != i})[:n_pos]
        other = sorted({(-dot(v, w), j) for j, w, z in good if z != y and j != i})
        for s, p in same:
            inside = [(-t, j) for t, j in other if low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(i, p, k + 1, j, -s, t) for k, (t, j) in enumerate(inside)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, **options).collect())


def float32(x):
    return None if x is None else float(np.float32(x))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for i in range(150):
        v = [float32(r.choice([-0.5, 0.0, 0.25, 0.3, 0.5, r.random()])) for _ in range(4)]
        out.append((i, v, r.randrange(3)))
    out += out[:20] + [(200 + i, out[7][1], i % 3) for i in range(30)]              # repeated rows, ties
    out += [(None, [1.0] * 4, 0), (300, None, 0), (305, [1.0] * 4, None), (310, [1.0, None, 0.0, 0.0], 0), (311, [float("nan")] * 4, 1),
            (315, [float("inf"), 0.0, 0.0, 0.0], 1), (320, [], 2), (325, [0.5], 1), (330, [0.5] * 9, 0), (5, [0.5, 0.5, 0.0, 0.0], 2), (335, [0.0] * 4, 0)]
    return out


@pytest.mark.parametrize("options", [{}, {"low": 50, "high": 120}, {"n_positives": 2, "n_negatives": 7}, {"block_cells": 40}])
def test_equals_brute_force(spark, rows, options):
    names = {"n_positives": "n_pos", "n_negatives": "n_neg"}
    want = brute(rows, **{names.get(k, k): v for k, v in options.items() if k != "block_cells"})
    assert want and run(spark, rows, **options) == want


def test_no_anchor_and_empty(spark, rows):
    assert run(spark, [r for r in rows if r[0] is not None and r[0] % 5]) == []
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0], 1)]) == []


def test_products_are_exact_beyond_floats():
    a = np.array([[2 ** 31 + 1, 3], [5, -7]], np.int64)
    assert negatives.products(a, a).tolist() == [[(2 ** 31 + 1) ** 2 + 9, 5 * (2 ** 31 + 1) - 21], [5 * (2 ** 31 + 1) - 21, 74]]


def test_quantize_saturates_and_pads():
    q, ok = negatives.quantize(pa.array([[0.5, -0.001], None, [1e308], [None]], pa.list_(pa.float64())), 256, 3)
    assert q[0].tolist() == [128, -1, 0] and q[2, 0] == 2 ** 62 and ok.tolist() == [True, False, True, False]
