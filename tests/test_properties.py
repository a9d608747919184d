"""Property tests: the column helpers against plain-Python statements of the
JVM semantics they reproduce, on random strings (one Spark job per example
batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loglens.functions import full_match, java_split, keyword_split, utf16_len
from loglens.functions.text import KEYWORD_REJECT


def ref_java_split(s: str) -> list[str]:
    """String.split(" "): no match gives the string itself; trailing empties dropped."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def ref_keywords(s: str) -> list[str]:
    toks = re.split(r"[ /,;()]", s)
    return [t.lower() for t in toks if len(t) > 0 and not re.search(KEYWORD_REJECT, t)]


ALPHABET = st.sampled_from(list("ab c  1._-/,;()xyZÉü\n😀"))
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=60)
SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(texts=TEXTS)
def test_java_split_and_length(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = df.select("i", java_split("v").alias("s"), utf16_len("v").alias("n")).collect()
    for r in rows:
        assert r.s == ref_java_split(texts[r.i]), repr(texts[r.i])
        assert r.n == len(texts[r.i].encode("utf-16-be")) // 2


@SETTINGS
@given(texts=TEXTS)
def test_keyword_tokens(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    toks = F.filter(keyword_split("v"), lambda t: (F.length(t) > 0) & ~t.rlike(KEYWORD_REJECT))
    rows = df.select("i", F.transform(toks, F.lower).alias("k")).collect()
    for r in rows:
        assert r.k == ref_keywords(texts[r.i]), repr(texts[r.i])


@SETTINGS
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("0123456789a \n")), max_size=6),
                      min_size=1, max_size=60))
def test_full_match(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = df.select("i", full_match("v", r"\d+").alias("m")).collect()
    for r in rows:
        assert r.m == (re.fullmatch(r"[0-9]+", texts[r.i]) is not None), repr(texts[r.i])
