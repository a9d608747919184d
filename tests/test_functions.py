from loglens.functions import full_match, java_split, utf16_len


def _one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expr.alias("r")).first()["r"]


def test_java_split_edge_cases(spark):
    # FIXTURES §2: JVM String.split(" ") drops trailing empty tokens only.
    cases = {
        "a b  c  ": ["a", "b", "", "c"],
        "": [""],
        "   ": [],
        " a": ["", "a"],
        "a😀": ["a😀"],
    }
    for text, expected in cases.items():
        assert _one(spark, java_split("v"), text) == expected, repr(text)


def test_utf16_length_counts_surrogate_pairs(spark):
    assert _one(spark, utf16_len("v"), "a😀") == 3
    assert _one(spark, utf16_len("v"), "a b  c  ") == 8
    assert _one(spark, utf16_len("v"), "") == 0
    assert _one(spark, utf16_len("v"), "   ") == 3


def test_full_match_is_whole_string(spark):
    df = spark.createDataFrame([("123",), ("abc",), ("4",), ("12\n",), ("5",), ("a1",)], "v string")
    kept = [r.v for r in df.where(full_match("v", r"\d+")).collect()]
    assert sorted(kept) == ["123", "4", "5"]


def test_floor_div_exact_for_large_and_negative(spark):
    from loglens.functions.numeric import floor_div
    big = 2 ** 62 + 7
    df = spark.createDataFrame([(big,), (-1,), (-256,), (-257,), (511,)], "v bigint")
    got = [r.q for r in df.select(floor_div("v", 256).alias("q")).collect()]
    assert got == [big // 256, -1, -1, -2, 1]
