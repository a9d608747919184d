"""Edge cases of the quality rules, url filter, preference format and decontamination."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from loglens.llm import decontaminate as dc, preference as pf, quality as ql, urls
from oracle_compare import compare


def _duck(**frames):
    con = duckdb.connect()
    for name, df in frames.items():
        con.register(f"_{name}", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM _{name}")
    return con


@pytest.fixture(scope="module")
def texts(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, long, None, "a"), (4, long + " #" * 200, None, None), (5, "a b c " * 60, "en", "a"),
            (6, "x\n" * 40 + long, "en", None), (7, long.upper(), "en", "a"), (7, long.upper(), "en", "a"), (None, long, "en", "a"),
            (8, "\x0b\x0c", "fr", "b"), (9, " ".join(f"v{i % 40}" for i in range(12_000)), "fr", "b"), (10, "É é\r\nÉ é\r\n" + long, "fr", "b"), (11, "a a a a " + long, "fr", "b")]
    rows += [(100 + i, f"{long} tail {i}", "en", "a") for i in range(120)]
    return spark.createDataFrame([(*r, True) for r in rows], "doc_id bigint, text string, lang string, source string, kept boolean").repartition(3)


def test_quality_edges_equal_sql(spark, texts, monkeypatch):
    got = ql.quality(texts)
    ok, msg = compare(got, _duck(documents=texts), ql.ORACLE_OP5)
    assert ok, msg
    kept = {(r.doc_id, r.kept) for r in got.collect()}
    assert {(3, True), (4, False), (7, False), (10, True), (1, False)} <= kept


def test_quality_filter_agrees_and_keeps_columns(spark, texts):
    out = ql.drop_poor(texts)
    assert out.columns == texts.columns
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(r.doc_id) for r in ql.quality(texts).where("kept").collect())
    assert ql.drop_poor(texts.where("false")).count() == 0 == ql.quality(texts.where("false")).count()


def test_sketch_quantiles_are_close(spark):
    df = spark.range(1, 20001).select((F.col("id") * 7 % 20001).alias("v"))
    b = df.select("v", ql._bucket(F.col("v")).alias("__b")).select("v", ql._floor(F.col("__b")).alias("low"), F.col("__b")) if False else df.withColumn("__b", ql._bucket(F.col("v")))
    rows = b.withColumn("low", ql._floor(F.col("__b"))).collect()
    assert all(r.low <= r.v < max(r.low + 1, r.low * 33 / 32 + 1) for r in rows)
    ordered = sorted((r.v, r["__b"]) for r in rows)
    assert [x[1] for x in ordered] == sorted(x[1] for x in ordered)


def test_url_edges_equal_sql(spark):
    link = lambda t: f'<html><link href="{t}" rel="canonical"></html>'
    rows = [(1, None, None), (2, "no scheme", "x"), (3, "http://A.Example.com/en/x?utm_source=1#f", None), (4, "https://www.example.com/en/x", ""),
            (5, "http://one.org/a", link("http://shop.net/fr/b")), (6, "http://m.one.org/a/", None), (7, "http://two.org/", link("//one.org/a")), (8, "http://three.org/p", '<META HTTP-EQUIV=refresh content="0; URL=http://two.org/">'),
            (9, "http://four.org/q", link("http://x.com/ok")), (9, "http://four.org/q", link("http://x.com/ok")), (10, "http://five.org/", link("http://four.org/q")), (11, "http://five.org/index", link("/")),
            (12, "http://com/", None), (13, "http://com", None), (None, "http://a.net/es/", None), (14, "http://six.org/z", link("rel/path")), (15, "http://notnet/es/x", None), (16, "ftp://u.net/es?x", None), (17, "http://a.org/x\ny://b", None)]
    pages = spark.createDataFrame([(*r, "v") for r in rows], "page_id bigint, url string, html string, verdict string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    got = urls.judge(pages, rules)
    ok, msg = compare(got, _duck(pages=pages), urls.ORACLE_OP9)
    assert ok, msg
    v = {r.page_id: r.verdict for r in got.collect()}
    assert v[5] == v[6] == v[7] == v[8] == "block" and v[9] == v[10] == v[11] == "allow" and v[1] == "allow" and v[4] == "allow"
    more = spark.createDataFrame([("http://six.org/z", "http://two.org/"), (None, "http://two.org/")], "from_url string, to_url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, rules, more).collect()}[14] == "block"
    assert urls.judge(pages.where("false"), rules).count() == 0


def test_every_link_of_a_page_is_an_edge(spark):
    """Each page but the first is an alias of a blocked one, or of one that nothing decides."""
    cases = [  # page url, html, target
        ("http://a.org/x", '<link rel="icon" href="/i"><link rel="alternate canonical" href="http://b.net/es/1">', "block"),
        ("http://c.org/x", '<link rel=canonical href=/self><link href="http://b.net/es/2" rel="canonical">', "block"),
        ("http://d.org/x", '<meta http-equiv="refresh" content="5"><META HTTP-EQUIV=Refresh CONTENT="0; URL=http://b.net/es/3;v=1">', "block"),
        ("http://e.org/x", "<meta content='0;url=\"http://b.net/es/4\"' http-equiv='refresh'>", "block"),
        ("http://f.org/x", '<link rel="canonical" href="http://b.net/es/5?a=1&amp;b=2">', "block"),
        ("http://g.org/x", '<link rel="canonical" href="http&#58;//b.net&#x2F;es/6&#47;&#1114112;&amp;amp;">', "block"),
        ("http://b.net/en/q/y", '<link rel="canonical" href="../../es/7/./z">', "block"),
        ("http://b.net/en", '<link rel="canonical" href="es/">', "block"),
        ("http://h.org/x", '<link rel="canonical" href="//b.net/es/8">', "block"),
        ("http://i.org/x", '<link rel="canonical" href="mailto:me@b.net/es/"><link data-rel="canonical" href="http://b.net/es/9"><link rel="canonicals" href="http://b.net/es/9">', "allow"),
        ("http://j.org/a/b?q=1#f", '<link rel="canonical" href="#top"><link rel="canonical" href="?z">', "allow"),
        ("http://j.org/a/b?z", '<link rel="canonical" href="http://b.net/es/10">', "block"),
        ("no url", '<link rel="canonical" href="es/">', "allow"),
        ("http://k.org", '<link rel="canonical" href="">' + "<p>" * 50_000, "allow"), ("http://l.org/é", '<link rel="canonical" href=" &#233;&#x1F600; ">', "allow"),
        ("http://l.org/é😀", '<link rel="canonical" href="http://b.net/es/11">', "block"),
    ]
    pages = spark.createDataFrame([(k, u, h) for k, (u, h, _) in enumerate(cases)], "page_id bigint, url string, html string")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    got = urls.judge(pages, rules)
    ok, msg = compare(got, _duck(pages=pages), urls.ORACLE_OP9)
    assert ok, msg
    linked = {k for k, (u, _, v) in enumerate(cases) if v == "block"} | {10, 14}  # by way of another page
    assert {r.page_id for r in got.collect() if r.verdict == "block"} == linked


def test_preference_edges(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 1, "assistant", "yo"), (1, 2, "user", None), (1, 3, "assistant", "end"), (2, 0, "user", "only"), (3, None, None, None), (3, 0, "assistant", "é😀"),
             (None, 0, "user", "x"), (4, 0, "assistant", "same"), (4, 1, "assistant", "same")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id bigint, turn int, role string, text string, pair_id int")
    ok, msg = compare(pf.format_pairs(pf.reply_pairs(df)).withColumns({c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["from"], s["to"])), ",") for c in ("chosen_mask", "rejected_mask")}),
                      _duck(conversations=df), pf.ORACLE_OP2)
    assert ok, msg
    assert pf.format_pairs(pf.reply_pairs(df.where("false"))).count() == 0


def test_preference_prefix_and_masks(spark):
    kind = "pair_id bigint, chosen array<struct<role: string, text: string>>, rejected array<struct<role: string, text: string>>"
    a, b, c = ("system", "s"), ("user", "q"), ("assistant", "good")
    pairs = spark.createDataFrame([(1, [a, b, c], [a, b, ("assistant", "bad"), ("user", "?"), c]), (2, [a], [a, b]), (3, [a, b], [a, b]), (4, None, [c]), (5, [("user", None)], [("user", "")])], kind)
    got = {r.pair_id: r for r in pf.format_pairs(pairs).collect()}
    assert [got[k].n_prefix for k in range(1, 6)] == [2, 1, 2, 0, 0]
    r = got[1]
    assert r.prompt == "<|system|>\ns<|end|>\n<|user|>\nq<|end|>\n"
    assert [r.rejected[m["from"]:m["to"]] for m in r.rejected_mask] == ["bad<|end|>\n", "good<|end|>\n"]
    assert [r.chosen[m["from"]:m["to"]] for m in r.chosen_mask] == ["good<|end|>\n"]
    assert got[2].chosen == "" and got[2].rejected == "<|user|>\nq<|end|>\n" and got[3].rejected == ""


@pytest.fixture(scope="module")
def leaks(spark):
    item = " ".join(f"i{k}" for k in range(25))
    docs = [(1, None), (2, ""), (3, f"x {item} y"), (4, f"X, {item.upper().replace(' ', '--')}!"), (5, " ".join(item.split()[:9])), (6, " ".join(item.split()[5:15]) + " z " + item), (7, "short One"), (7, "short One"), (None, "a short one b"), (8, "é ü"), (9, "w " * 20_000 + item),
            (10, "rep rep rep rep rep rep rep rep rep rep rep rep"), (11, "rep " * 9)]
    items = [(1, item), (1, item), (2, "Short, one."), (3, None), (4, ""), (5, "é  ü"), (10, item + " more"), (None, "x y"), (6, "rep " * 10)]
    return (spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, n_words int"), spark.createDataFrame(items, "item_id bigint, text string"))


def _digest(found):
    return found.select("doc_id", "n_words", dc._covered(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@pytest.mark.parametrize("block", [500_000, 7])
def test_decontamination_edges_equal_sql(spark, leaks, block):
    docs, items = leaks
    ok, msg = compare(_digest(dc.contamination(docs, items, block_windows=block)), _duck(documents=docs, benchmark=items), dc.ORACLE_OP10)
    assert ok, msg


@pytest.mark.parametrize("block", [500_000, 7])
def test_drop_contaminated(spark, leaks, block):
    docs, items = leaks
    bad = {repr(r.doc_id) for r in _digest(dc.contamination(docs, items)).where("contaminated").collect()}
    out = dc.drop_contaminated(docs, items, block_windows=block)
    assert out.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(r.doc_id) for r in docs.collect() if repr(r.doc_id) not in bad)


def test_decontamination_of_empty_tables(spark, leaks):
    docs, items = leaks
    assert dc.contamination(docs.where("false"), items).count() == 0
    r = dc.contamination(docs, items.where("false")).collect()
    assert len(r) == docs.count() and not any(x.spans for x in r)
    assert hashlib.sha256(b"").hexdigest() == _digest(dc.contamination(docs, items.where("false"))).first().items_sha256
