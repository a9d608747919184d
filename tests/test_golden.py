"""Golden results of the inline programs (FIXTURES §1)."""


import pytest
from pyspark.sql import functions as F

from loglens.operators import (
    check_serializable, concat_ordered, concat_udaf, filter_with_partition_resource,
    member_filter, observe_sum, predicate_udf, regex_filter, regex_predicate_udf, total_sum,
)
from loglens.sources import inline


def test_long_accumulator_sum(spark):
    ints = inline(spark, [(v,) for v in [1, 2, 3, 4, 5]], "v int")
    assert total_sum(ints, "v").first()["total"] == 15


def test_observed_sum_is_side_result_of_an_action(spark):
    ints = inline(spark, [(v,) for v in [1, 2, 3, 4, 5]], "v int")
    observed, obs = observe_sum(ints, "v", "adds_up")
    assert observed.count() == 5
    assert obs.get["adds_up"] == 15


def test_string_accumulator_in_defined_order(spark):
    words = inline(spark, [(2, "two"), (1, "one"), (3, "three")], "pos int, v string")
    assert concat_ordered(words, "v", "pos").first()["text"] == "onetwothree"


def test_string_accumulator_empty_is_empty_string(spark):
    empty = inline(spark, [], "pos int, v string")
    assert concat_ordered(empty, "v", "pos").first()["text"] == ""


def test_string_accumulator_chunks_concatenate_to_whole(spark):
    rows = [(i, chr(ord("a") + i % 26)) for i in range(95)]
    df = inline(spark, rows, "pos bigint, v string")
    chunks = concat_ordered(df, "v", "pos", chunk_width=10).orderBy("chunk").collect()
    assert len(chunks) == 10
    assert "".join(r.text for r in chunks) == "".join(v for _, v in rows)
    udaf = concat_udaf(df.withColumn("chunk", F.floor(F.col("pos") / 10)), "v", "pos", "chunk")
    assert sorted(map(tuple, udaf.collect())) == sorted(map(tuple, chunks))


def test_broadcast_set_filter(spark):
    words = inline(spark, [(w,) for w in ["one", "two", "three", "four"]], "w string")
    kept = member_filter(words, "w", ["one", "two", "three"])
    assert sorted(r.w for r in kept.collect()) == ["one", "three", "two"]
    keep_df = inline(spark, [("one",), ("two",), ("three",)], "k string")
    kept_df = member_filter(words, "w", keep_df)
    assert sorted(r.w for r in kept_df.collect()) == ["one", "three", "two"]


MIXED = ["123", "abc", "4", "5"]


def test_regex_predicate_three_ways(spark):
    df = inline(spark, [(v,) for v in MIXED], "v string")
    expected = ["123", "4", "5"]
    assert sorted(r.v for r in regex_filter(df, "v", r"\d+").collect()) == expected
    udf = regex_predicate_udf(r"\d+")
    assert sorted(r.v for r in df.where(udf("v")).collect()) == expected
    py = predicate_udf(lambda s: s.isdigit())
    assert sorted(r.v for r in df.where(py("v")).collect()) == expected


class _DigitFile:
    """Keeps a binary file open, which cannot be pickled."""

    def __init__(self, path):
        self.handle = open(path, "rb")
        self.digits = set(self.handle.read().decode())

    def all_in(self, text):
        return text != "" and set(text) <= self.digits


@pytest.fixture
def digit_path(tmp_path):
    p = tmp_path / "digits"
    p.write_text("0123456789")
    return str(p)


def test_closure_over_open_file_fails_before_running(spark, digit_path):
    handle = open(digit_path, "rb")
    with pytest.raises(TypeError, match="cannot be serialized"):
        predicate_udf(lambda s: s in handle.read())
    handle.close()


def test_object_with_open_file_fails_before_running(spark, digit_path):
    held = _DigitFile(digit_path)
    with pytest.raises(TypeError, match="cannot be serialized"):
        predicate_udf(held.all_in)
    with pytest.raises(TypeError):
        check_serializable(held)


def test_resource_built_per_partition(spark, digit_path):
    df = inline(spark, [(v,) for v in MIXED], "v string").repartition(3)
    kept = filter_with_partition_resource(df, "v", lambda: _DigitFile(digit_path), lambda r, s: s.map(r.all_in))
    assert sorted(r.v for r in kept.collect()) == ["123", "4", "5"]


def test_vectorised_predicate(spark):
    from loglens.operators import series_predicate_udf
    df = inline(spark, [(v,) for v in MIXED], "v string")
    assert sorted(r.v for r in df.where(series_predicate_udf(lambda s: s.str.isdigit())("v")).collect()) == ["123", "4", "5"]


def test_user_aggregate_merges_partial_states(spark):
    from loglens.operators import span_udaf, user_aggregate
    df = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id % 7 as string)) as g").repartition(5)
    got = {r.g: r.n for r in user_aggregate(df, "g", ["id"], "n bigint", lambda: 0, lambda s, v: s + 1, lambda a, b: a + b, int).collect()}
    assert got == {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    edge = inline(spark, [(None, 1), (None, 5), ("a", None)], "g string, v bigint")
    assert {r.g: r.span for r in span_udaf(edge, "v", "g").collect()} == {None: 4, "a": None}


def test_quiet_slots_report_zero(spark):
    import datetime as dt
    from loglens.operators import tumbling_counts
    base = dt.datetime(2024, 1, 1)
    rows = [(base,), (base + dt.timedelta(hours=1),), (base + dt.timedelta(days=2),)]
    df = inline(spark, rows, "ts timestamp_ntz")
    got = [tuple(r) for r in tumbling_counts(df, "ts", 86400).orderBy("window_start").collect()]
    day0 = 1704067200
    assert got == [(day0, 2, "received 2 events"), (day0 + 86400, 0, "received 0 events"),
                   (day0 + 2 * 86400, 1, "received 1 events")]


def test_rows_without_a_time_are_counted(spark):
    import datetime as dt
    from loglens.operators import tumbling_counts
    df = inline(spark, [(dt.datetime(2024, 1, 1),), (None,), (None,)], "ts timestamp_ntz")
    got = {tuple(r) for r in tumbling_counts(df, "ts", 86400).collect()}
    assert got == {(1704067200, 1, "received 1 events"), (None, 2, "received 2 events")}
    assert tumbling_counts(df.where("false"), "ts", 86400).count() == 0


def test_set_filter_takes_any_number_of_keys(spark):
    words = inline(spark, [(w,) for w in ["one", "two", "three", "four", "k199999"]], "w string")
    keys = inline(spark, [("one",), ("two",), ("three",)], "k string")
    assert sorted(r.w for r in member_filter(words, "w", keys).collect()) == ["one", "three", "two"]
    assert [r.w for r in member_filter(words, "w", [f"k{i}" for i in range(200_000)]).collect()] == ["k199999"]
