"""Running totals over range partitions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from loglens.operators.scan import running_totals


def expected(rows, grouped):
    seen, out = {}, []
    for g, at, x, y in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or "") if grouped else 0, r[1])):
        a, b = seen.get(g if grouped else 0, (0, 0))
        out.append((at, a, b))
        seen[g if grouped else 0] = (a + (x or 0), b + (y or 0))
    return sorted(out)


@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("hot", [0.0, 0.6, 1.0])
def test_running_totals(spark, grouped, hot):
    r = random.Random(5)
    rows = [("hot" if r.random() < hot else r.choice([None, "a", "b", f"k{i // 9}"]), i, r.choice([None, 0, 1, 2 ** 40]), r.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, at bigint, x bigint, y bigint").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = running_totals(df, [F.col("at")], ["x", "y"], "g" if grouped else None)
        assert got.columns == ["g", "at", "x", "y", "before_x", "before_y"]
        assert sorted((t["at"], t["before_x"], t["before_y"]) for t in got.collect()) == expected(rows, grouped)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_one_row(spark):
    df = spark.createDataFrame([], "g string, at bigint, x bigint")
    assert running_totals(df, [F.col("at")], ["x"], "g").collect() == []
    one = spark.createDataFrame([(None, 1, 5)], "g string, at bigint, x bigint")
    assert [tuple(r) for r in running_totals(one, [F.col("at")], ["x"]).collect()] == [(None, 1, 5, 0)]
