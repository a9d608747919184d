"""Text sources: one row per line, column ``value``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.session import staging_dir
from loglens.sources.tables import read_table


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read text files (a file, folder or glob) as ``value string``, one row per line.

    Splitting on line ends is done by the file reader itself, in parallel
    over file splits, so a single large file is still read by many tasks.
    """
    return spark.read.text(path)


def document_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """Lines of every document: ``doc_id bigint, value string``.

    A document is one row, so its lines come from a per-row ``explode`` with
    no shuffle.
    """
    docs = read_table(spark, data_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("value"))


def stage_text(df: DataFrame, column: str = "value", name: str = "text") -> str:
    """Write one string column as text files in a new staging folder; return its path."""
    path = staging_dir(df.sparkSession, name)
    df.select(F.col(column).alias("value")).write.mode("errorifexists").text(path)
    return path


def inline(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """A small DataFrame from driver-side values (``parallelize`` of the RDD API).

    Only for inputs whose size is fixed by the caller: literal sets,
    fixtures, parameters.
    """
    return spark.createDataFrame(list(rows), schema)
