"""Word count and longest line over text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions.text import java_split, utf16_len


def tokenize(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = (),
             drop_empty: bool = False) -> DataFrame:
    """One row per space-separated token (``flatMap(_.split(" "))``).

    Empty tokens from repeated spaces or blank lines are kept unless
    ``drop_empty``; they are words in the JVM split.  Row-local, no shuffle.
    """
    out = lines.select(*keep, F.explode(java_split(column)).alias("word"))
    return out.where(F.col("word") != "") if drop_empty else out


def word_count(lines: DataFrame, column: str = "value", drop_empty: bool = False) -> DataFrame:
    """``word string, n bigint``: occurrences per word.

    The count is algebraic, so Spark adds a partial aggregate before the
    shuffle: a word that fills a third of the input still sends one row per
    map task, not its occurrences.
    """
    return (tokenize(lines, column, drop_empty=drop_empty)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def word_count_sorted(lines: DataFrame, column: str = "value",
                      drop_empty: bool = False) -> DataFrame:
    """Word count, most frequent first; ties by word (range-partitioned sort)."""
    return word_count(lines, column, drop_empty).orderBy(F.desc("n"), F.asc("word"))


def line_lengths(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``line string, len bigint`` with JVM (UTF-16) lengths."""
    return lines.select(*keep, F.col(column).alias("line"), utf16_len(column).alias("len"))


def longest_line(lines: DataFrame, column: str = "value") -> DataFrame:
    """The longest line as one row ``line, len``; ties go to the smaller line.

    ``min(struct(-len, line))`` is one algebraic aggregate: every task keeps
    a single candidate and only those meet in the final step.  Empty input
    gives one row of NULLs.
    """
    best = line_lengths(lines, column).agg(
        F.min(F.struct((-F.col("len")).alias("neg_len"), F.col("line"))).alias("best"))
    return best.select(F.col("best.line").alias("line"), (-F.col("best.neg_len")).alias("len"))
