"""Token counts against a plain segmentation of every word."""

from loglens.llm import token_counts as tc


def _plain(word, pieces, penalty):
    word = tc.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(end):
            s = pieces.get(word[start:end])
            if s is not None:
                ways.append((best[start][0] + s, -(best[start][1] + 1)))
        if word[end - 1] not in pieces:
            ways.append((best[end - 1][0] + penalty, -(best[end - 1][1] + len(word[end - 1].encode()))))
        v, n = max(ways)
        best.append((v, -n))
    return best[-1][1]


def _expect(text, pieces, penalty):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    return len(words), sum(_plain(w, pieces, penalty) for w in words)


def test_counts_equal_plain_segmentation(spark):
    pieces = tc.load_pieces()
    penalty = min(pieces.values()) - 10.0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(-1, None), (-2, ""), (-3, " \n"), (-4, "中文 😀x a​b Ж"), (-5, "z" * 3000), (-6, "same same"), (-6, "same same"), (None, "id")]
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id bigint, text string, n_tokens int").repartition(4)
    got = sorted(repr((r.doc_id, r.n_words, r.n_tokens)) for r in tc.token_counts(df).collect())
    assert got == sorted(repr((d, *_expect(t, pieces, penalty))) for d, t in rows)
    assert tc.token_counts(df.where("false")).count() == 0


def test_shared_prefixes_and_ties():
    pieces = {"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁ab": -3.0, "c": -9.0}
    children, score = tc.piece_trie(pieces)
    words = sorted(["a", "ab", "abab", "abc", "b", "", "abx"])
    assert tc.count_words(words, children, score, -20.0) == [_plain(w, pieces, -20.0) for w in words]


def test_white_space_has_tokens(spark, tmp_path):
    texts = ["a b", "a  b", "a\nb", "a\n\n\nb", "a\tb", " a", "a ", "\n", "  ", "", None, "a \n b", "a" + " " * 18 + "b", "a\r\n\x0b", "  ", " x", " é  é "]
    expect = [0, 1, 1, 3, 1, 1, 1, 2, 1, 0, 0, 2, 2, 3, 1, 1, 3]  # the library's tokens without those of the words
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    words = {r.doc_id: r.n_tokens for r in tc.token_counts(df).collect()}
    got = {r.doc_id: r.n_tokens for r in tc.q_op4(spark, str(tmp_path)).collect()}
    assert [got[i] - words[i] for i in range(len(texts))] == expect
