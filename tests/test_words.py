from loglens.operators import line_lengths, longest_line, tokenize, word_count, word_count_sorted
from loglens.sources import inline


def _lines(spark, values):
    return inline(spark, [(v,) for v in values], "value string")


def test_word_count_keeps_empty_words_like_the_jvm_split(spark):
    lines = _lines(spark, ["a b  c  ", "", "   ", " a", "b a"])
    got = {r.word: r.n for r in word_count(lines).collect()}
    # "a b  c  " -> a b '' c ; "" -> '' ; "   " -> nothing ; " a" -> '' a ; "b a" -> b a
    assert got == {"a": 3, "b": 2, "c": 1, "": 3}
    no_empty = {r.word: r.n for r in word_count(lines, drop_empty=True).collect()}
    assert "" not in no_empty


def test_word_count_sorted_order(spark):
    lines = _lines(spark, ["x y y z z z", "y"])
    got = [(r.word, r.n) for r in word_count_sorted(lines).collect()]
    assert got == [("y", 3), ("z", 3), ("x", 1)]


def test_tokenize_keeps_columns(spark):
    df = inline(spark, [(7, "p q")], "doc_id bigint, value string")
    assert [(r.doc_id, r.word) for r in tokenize(df, keep=("doc_id",)).collect()] == [(7, "p"), (7, "q")]


def test_longest_line_utf16_and_tie_rule(spark):
    lines = _lines(spark, ["bbb", "aaa", "a😀", "cc"])
    row = longest_line(lines).first()
    # three lines of UTF-16 length 3; the smallest line wins the tie
    assert (row.line, row.len) == ("aaa", 3)
    lens = {r.line: r.len for r in line_lengths(lines).collect()}
    assert lens["a😀"] == 3


def test_longest_line_of_nothing_is_null(spark):
    row = longest_line(_lines(spark, [])).first()
    assert row.line is None and row.len is None
