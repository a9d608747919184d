"""User aggregates: exact on nullable longs, merged in a tree."""

import math

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from loglens.operators import span_udaf, udfs, user_aggregate

BIG = 9007199254740993


def test_nullable_longs_are_exact(spark):
    df = spark.createDataFrame([(1, BIG), (1, BIG - 1), (1, None)], "g bigint, v bigint").coalesce(1)
    assert [tuple(r) for r in span_udaf(df, "v", "g").collect()] == [(1, 1)]


def test_nullable_long_keys_stay_apart(spark):
    df = spark.createDataFrame([(BIG, 1), (BIG - 1, 5), (None, 7), (None, None)], "g bigint, v bigint").coalesce(1)
    assert {r.g: r.span for r in span_udaf(df, "v", "g").collect()} == {BIG: 0, BIG - 1: 0, None: 0}
    none = spark.createDataFrame([(1, None)], "g bigint, v bigint")
    assert [tuple(r) for r in span_udaf(none, "v", "g").collect()] == [(1, None)]
    assert span_udaf(none.where("false"), "v", "g").collect() == []


def test_float_keys_zero_and_nan(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 4), (float("nan"), 2), (float("nan"), 9), (1.5, 3)], "g double, v bigint").repartition(5)
    got = {("nan" if math.isnan(r.g) else r.g): r.span for r in span_udaf(df, "v", "g").collect()}
    assert got == {0.0: 3, "nan": 7, 1.5: 0}


@pytest.mark.parametrize("batched", [True, False])
def test_a_hot_group_is_merged_in_a_tree(spark, batched, monkeypatch):
    """Every state counts what was merged into it directly: no task merges all states of the hot group."""
    n = 300
    df = spark.range(0, 30 * n, 1, n).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("g"), F.col("id").alias("v"))
    # a state: (sum, states merged by the current task); pickling to another task starts a new count
    zero = lambda: (0, 0)
    merge = lambda a, b: (a[0] + b[0], max(a[1], b[1]) + 1)
    options = {"add_batch": lambda s, x: (s[0] + pc.sum(x).as_py(), 0), "add": None} if batched else {"add": lambda s, x: (s[0] + x, 0)}
    out = user_aggregate(df, "g", ["v"], "r struct<total: bigint, merges: int>", zero, merge=merge, value=lambda s: {"total": s[0], "merges": s[1]}, **options)
    got = {r.g: r.r for r in out.collect()}
    assert len(got) == 10 * n + 1
    assert got[-1].total == sum(x for x in range(30 * n) if x % 3)
    # the longest chain of merges: n / SPREAD in the first level, SPREAD in the last
    assert got[-1].merges <= udfs.SPREAD + n // udfs.SPREAD + 1


def test_either_form_of_add(spark):
    with pytest.raises(ValueError):
        user_aggregate(spark.range(1), "id", ["id"], "x bigint", list, add=None, merge=None, value=None)
