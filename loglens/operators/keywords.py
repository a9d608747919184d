"""Keywords of user-agent strings, their frequency and the top keywords per client."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.functions.text import KEYWORD_REJECT, keyword_split


def agent_keywords(df: DataFrame, ip: str, agent: str) -> DataFrame:
    """``<ip>, keyword``: one row per keyword occurrence.

    Tokens come from splitting on space, ``/ , ; ( )``; empty tokens and any
    token containing a digit, ``.``, ``_`` or ``-`` are dropped, and the rest
    is lower-cased.  Row-local, no shuffle.
    """
    tok = df.select(F.col(ip), F.explode(keyword_split(agent)).alias("__tok"))
    keep = (F.length("__tok") > 0) & ~F.col("__tok").rlike(KEYWORD_REJECT)
    return tok.where(keep).select(ip, F.lower("__tok").alias("keyword"))


def keyword_freq(keywords: DataFrame) -> DataFrame:
    """``keyword, freq bigint``: occurrences over all clients (partial + final aggregate)."""
    return keywords.groupBy("keyword").agg(F.count(F.lit(1)).alias("freq"))


def distinct_keywords(keywords: DataFrame, ip: str) -> DataFrame:
    """Distinct ``<ip>, keyword`` pairs (map-side de-duplication first)."""
    return keywords.select(ip, "keyword").distinct()


def top_keywords(keywords: DataFrame, ip: str, n: int = 50) -> DataFrame:
    """Per client, its keywords by global frequency: ``<ip>, keyword, freq, rank``.

    Frequency descending, ties by keyword.  Per-client counts give both the
    distinct pairs and, summed per keyword, the global frequency; both sides of
    the join keep the count, so they share one exchange and the text is split
    once.  A keyword that nearly every client has is a skewed key of that
    join, which AQE splits; the ranking keeps at most ``n`` rows per client in
    each task before the shuffle.
    """
    per_client = keywords.groupBy(ip, "keyword").agg(F.count(F.lit(1)).alias("__n"))
    freq = per_client.groupBy("keyword").agg(F.sum("__n").alias("freq"))
    with_freq = per_client.where("__n > 0").join(freq, "keyword")
    order = Window.partitionBy(ip).orderBy(F.desc("freq"), F.asc("keyword"))
    ranked = with_freq.withColumn("rank", F.row_number().over(order))
    return (ranked.where(F.col("rank") <= n)
                  .select(ip, "keyword", "freq", F.col("rank").cast("bigint").alias("rank")))


def agents_of(df: DataFrame, ip: str, agent: str, value=None) -> DataFrame:
    """A client's agent strings in string order (all clients when ``value`` is None).

    A global, range-partitioned sort: no client's list is gathered in one
    task.
    """
    rows = df.select(F.col(ip), F.col(agent))
    if value is not None:
        rows = rows.where(F.col(ip) == F.lit(value))
    return rows.orderBy(F.asc(ip), F.asc(agent))
