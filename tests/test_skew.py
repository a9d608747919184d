"""One key holding a third of the rows must not land in one join task."""

from pyspark.sql import functions as F

from loglens.operators import hot_split_join


def test_hot_split_join_equals_plain_join(spark):
    n = 30_000
    big = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("key"),
        F.col("id"))
    lookup = big.groupBy("key").agg(F.count(F.lit(1)).alias("w"))
    split = hot_split_join(big, lookup, "key", "w", hot_fraction=0.01)
    plain = big.join(lookup, "key")
    assert sorted(map(tuple, split.select("key", "id", "w").collect())) == \
        sorted(map(tuple, plain.select("key", "id", "w").collect()))
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_hot_keys_bounded_by_fraction(spark):
    lookup = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("w"))
    big = lookup.select("key")
    # every key has weight 1/1000 of the total: with a 1 % threshold none is hot
    out = hot_split_join(big, lookup, "key", "w", hot_fraction=0.01)
    assert out.count() == 1000


def test_zero_weights_are_never_hot(spark):
    lookup = spark.range(5).select(F.col("id").cast("string").alias("key"), F.lit(0).alias("w"))
    out = hot_split_join(lookup.select("key"), lookup, "key", "w", hot_fraction=0.5)
    assert out.count() == 5
