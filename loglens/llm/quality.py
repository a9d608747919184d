"""Quality rules with adaptive thresholds, by DataFrame operations only.

Words are runs of characters outside ASCII white space.  Two fixed base rules
(too few words, mostly repeated 3-word windows) come first.  The adaptive rules
bound three shares, in per mille: symbols per word, capital letters A-Z per word
character, and repeated lines per line.  Their thresholds come from quantile
sketches per language and source over all documents that pass the base rules: a
sketch counts values in buckets of at most 1/32 relative width, so sketches
merge by adding counts, do not depend on the order of rows, and have a few
hundred entries at most.  A threshold is the outer fence of the sketch's
quartiles, q75 + 3 * (q75 - q25), plus a fixed slack, so that a uniform group
does not reject ordinary variation.  Groups of fewer than ``min_group``
documents use the merged sketch of their language, and languages with fewer that
of all documents.

Nulls: a null text has no words and fails the base rules; null languages and
sources are groups of their own.  Texts of any length are handled as a whole;
repeated rows count repeatedly and get the same verdict.  Helper columns start
with ``__q_``, so other columns may have any other name.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglens.llm.tables import Staged, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEATED = 50        # per cent of words
MIN_GROUP = 100          # documents
#: Slack above the outer fence, per mille.
SLACK = {"symbols": 100, "capitals": 150, "lines": 350}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns with ``__q_<metric>`` columns of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    space = F.lit(SPACE)
    trimmed = F.btrim(text, space)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, space) != "")
    df = docs.withColumns({
        "__q_w": F.when(trimmed == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")),
        "__q_lines": lines,
        "__q_word_chars": F.char_length(_without(text, SPACE)).cast("bigint"),
        "__q_n_symbols": (F.char_length(text) - F.char_length(_without(text, SYMBOLS))).cast("bigint"),
        "__q_n_capitals": (F.char_length(text) - F.char_length(_without(text, CAPITALS))).cast("bigint"),
    })
    # Words by hash, then each 3-word window by hash.
    df = df.withColumns({"__q_h": F.transform("__q_w", lambda x: F.xxhash64(x)), "__q_n_words": F.size("__q_w").cast("bigint"),
                         "__q_n_lines": F.size("__q_lines").cast("bigint"),
                         "__q_n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("bigint")}).drop("__q_w", "__q_lines")
    windows = F.slice("__q_h", 1, F.greatest(F.size("__q_h") - 2, F.lit(0)))
    df = df.withColumn("__q_g", F.transform(windows, lambda x, i: F.xxhash64(x, F.get("__q_h", i + 1), F.get("__q_h", i + 2)))).drop("__q_h")
    # A window's hash, cut by the bits of a position, with its position below: once sorted, equal windows are neighbours.
    df = df.withColumn("__q_b", F.length(F.bin(F.size("__q_g"))))
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__q_b")) - 1
    df = df.withColumn("__q_s", F.sort_array(F.transform("__q_g", lambda x, i: F.coalesce(F.call_function("shiftleft", x, F.col("__q_b")).bitwiseOR(i.cast("bigint")), F.lit(0).cast("bigint")))))
    df = df.withColumn("__q_m", low)

    def window(packed: Column) -> Column:
        return F.get("__q_g", packed.bitwiseAND(F.col("__q_m")).cast("int"))

    def repeated(x: Column, i: Column) -> Column:
        own = window(x)
        beside = lambda k: F.coalesce(own == window(F.get("__q_s", k)), F.lit(False))
        return beside(i - 1) | beside(i + 1)

    df = df.withColumn("__q_r", F.sort_array(F.transform(F.filter("__q_s", repeated), lambda x: F.coalesce(x.bitwiseAND(F.col("__q_m")), F.lit(0).cast("bigint")))))
    start = F.struct(F.lit(-3).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate("__q_r", start, lambda acc, x: F.struct(x.alias("at"), (acc["n"] + F.least(F.lit(3).cast("bigint"), x - acc["at"])).alias("n")), lambda acc: acc["n"])
    df = df.withColumn("__q_n_repeat_words", covered).drop("__q_g", "__q_b", "__q_s", "__q_m", "__q_r")
    n = F.col("__q_n_words")
    failed = (n < MIN_WORDS) | (F.lit(100) * F.col("__q_n_repeat_words") > F.lit(MAX_REPEATED) * n)

    def share(part: str, whole: str) -> Column:
        return F.expr(f"(1000 * __q_{part}) div greatest(__q_{whole}, 1)")

    return df.withColumns({"__q_base_failed": failed, "__q_symbols": share("n_symbols", "n_words"),
                           "__q_capitals": share("n_capitals", "word_chars"), "__q_lines": share("n_dup_lines", "n_lines"),
                           "__q_row": F.monotonically_increasing_id()})


def _where(measured: DataFrame, condition: Column) -> DataFrame:
    """Filter measured rows; naming the row number keeps the optimizer from measuring the text anew inside the filter."""
    return measured.where(condition & (F.col("__q_row") >= 0))


def _bucket(v: Column) -> Column:
    """A value's bucket: itself below 64, then 32 buckets for each power of two."""
    e = F.length(F.bin(v)) - 1
    return F.when(v < 64, v).otherwise((e - 5) * 32 + F.call_function("shiftright", v, e - 5)).cast("bigint")


def _floor(b: Column) -> Column:
    """The smallest value of a bucket."""
    e = F.expr("cast(__b div 32 as int)")
    return F.when(b < 64, b).otherwise(F.call_function("shiftleft", F.lit(32).cast("bigint") + F.pmod(b, F.lit(32)), e - 1)).cast("bigint")


def sketches(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, metric, bucket, n): the sketch of every metric and group, over documents that pass the base rules."""
    names = list(SLACK)
    metrics = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), _bucket(F.col(f"__q_{m}")).alias("bucket")) for m in names)))
    return (_where(measured, ~F.col("__q_base_failed")).select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), metrics.alias("x"))
            .groupBy("lang", "source", "x.metric", "x.bucket").agg(F.count("*").alias("n")))


def _fences(sketch: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Merge the sketches of equal keys; per key the number of documents and each metric's threshold."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    ranked = merged.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "total": F.sum("n").over(group)})
    quart = ranked.groupBy(*keys, "metric").agg(
        F.max("total").alias("docs"), *(F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket"))).alias(f"b{k}") for k in (1, 3)))
    quart = quart.withColumn("__b", F.col("b1")).withColumn("q1", _floor(F.col("b1"))).withColumn("__b", F.col("b3")).withColumn("q3", _floor(F.col("b3")))
    slack = F.element_at(F.create_map(*(F.lit(v) for kv in SLACK.items() for v in kv)), F.col("metric"))
    fence = F.col("q3") + 3 * (F.col("q3") - F.col("q1")) + slack
    return quart.withColumn("fence", fence).groupBy(*keys).agg(
        F.max("docs").alias(f"{prefix}docs"), *(F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"{prefix}{m}") for m in SLACK))


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, <metric> ...): the thresholds of every group that has a sketch."""
    own, by_lang, overall = _fences(sketch, ["lang", "source"], "s_"), _fences(sketch, ["lang"], "l_"), _fences(sketch.withColumn("one", F.lit(1)), ["one"], "a_")
    langs = by_lang.withColumnRenamed("lang", "__lang")
    df = own.join(langs, F.col("lang").eqNullSafe(F.col("__lang"))).withColumn("one", F.lit(1)).join(overall, "one")
    level = F.when(F.col("s_docs") >= min_group, "s").when(F.col("l_docs") >= min_group, "l").otherwise("a")
    return df.withColumn("level", level).select("lang", "source", *(
        F.when(F.col("level") == "s", F.col(f"s_{m}")).when(F.col("level") == "l", F.col(f"l_{m}")).otherwise(F.col(f"a_{m}")).alias(m) for m in SLACK))


def judged(measured: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The measured rows with ``__q_kept``."""
    right = limits.select(F.col("lang").alias("__q_lang"), F.col("source").alias("__q_source"), *(F.col(m).alias(f"__q_max_{m}") for m in SLACK))
    out = measured.join(right, F.col(lang_col).eqNullSafe(F.col("__q_lang")) & F.col(source_col).eqNullSafe(F.col("__q_source")), "left")
    fits = F.lit(True)
    for m in SLACK:
        fits = fits & (F.col(f"__q_{m}") <= F.col(f"__q_max_{m}"))
    return out.withColumn("__q_kept", ~F.col("__q_base_failed") & F.coalesce(fits, F.lit(True)))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            min_group: int = MIN_GROUP) -> DataFrame:
    """One row per document row: doc_id, the base metrics, base_failed and kept."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    measured = Staged(with_metrics(own).drop("text"), "quality-metrics").df
    limits = Staged(thresholds(sketches(measured), min_group), "quality-thresholds").df
    return judged(measured, limits).select("doc_id", *(F.col(f"__q_{m}").alias(m) for m in [*BASE, "base_failed", "kept"]))


def drop_poor(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """The kept documents with all their columns; texts are measured twice instead of being shuffled."""
    measured = with_metrics(docs, text_col)
    limits = Staged(thresholds(sketches(measured, lang_col, source_col), min_group), "quality-thresholds").df
    return _where(judged(measured, limits, lang_col, source_col), F.col("__q_kept")).select(*docs.columns)


def q_op5(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


ORACLE_OP5 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT rid, i, list_value(w[i], w[i + 1], w[i + 2]) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
r AS (SELECT rid, g FROM p GROUP BY rid, g HAVING count(*) > 1),
c AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS q FROM p JOIN r USING (rid, g)) GROUP BY rid),
m AS (SELECT rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
        length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1000 * n_symbols // greatest(n_words, 1) AS symbols,
        1000 * n_capitals // greatest(word_chars, 1) AS capitals, 1000 * n_dup_lines // greatest(n_lines, 1) AS lines FROM m),
x AS (SELECT lang, source, u.metric AS metric, u.v AS v FROM (SELECT lang, source, unnest([{'metric': 'symbols', 'v': symbols}, {'metric': 'capitals', 'v': capitals},
        {'metric': 'lines', 'v': lines}]) AS u FROM f WHERE NOT base_failed)),
z AS (SELECT lang, source, metric, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS v FROM x),
s AS (SELECT lang, source, metric, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM z GROUP BY ALL),
l AS (SELECT lang, metric, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM z GROUP BY ALL),
a AS (SELECT metric, count(*) AS docs, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM z GROUP BY ALL),
k AS (SELECT s.lang, s.source, s.metric, CASE WHEN s.docs >= 100 THEN s.q3 + 3 * (s.q3 - s.q1) WHEN l.docs >= 100 THEN l.q3 + 3 * (l.q3 - l.q1)
        ELSE a.q3 + 3 * (a.q3 - a.q1) END + CASE s.metric WHEN 'symbols' THEN 100 WHEN 'capitals' THEN 150 ELSE 350 END AS fence
      FROM s JOIN l ON s.metric = l.metric AND s.lang IS NOT DISTINCT FROM l.lang JOIN a ON s.metric = a.metric),
t AS (SELECT lang, source, max(fence) FILTER (metric = 'symbols') AS fs, max(fence) FILTER (metric = 'capitals') AS fc, max(fence) FILTER (metric = 'lines') AS fl
      FROM k GROUP BY lang, source)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= fs AND capitals <= fc AND lines <= fl, true) AS kept
FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source
"""
