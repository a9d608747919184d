"""Accumulator-style aggregates: sums and ordered string concatenation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loglens.functions.numeric import floor_div
from loglens.operators.scan import running_totals


def total_sum(df: DataFrame, column: str, alias: str = "total") -> DataFrame:
    """One row with the sum of ``column`` as ``bigint`` (a long accumulator)."""
    return df.agg(F.coalesce(F.sum(F.col(column).cast("bigint")), F.lit(0).cast("bigint"))
                  .alias(alias))


def observe_sum(df: DataFrame, column: str, name: str = "total") -> tuple[DataFrame, Observation]:
    """Attach a named sum to ``df`` as an observed metric.

    The metric is filled when an action runs over the returned DataFrame,
    as a side result of that job (no second pass).  Read it from the
    returned ``Observation`` with ``.get``.
    """
    obs = Observation(name)
    observed = df.observe(obs, F.coalesce(F.sum(F.col(column).cast("bigint")),
                                          F.lit(0).cast("bigint")).alias(name))
    return observed, obs


def observed_total(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Run ``df`` once through a no-op sink and return its observed sum as one row."""
    observed, obs = observe_sum(df, column, name)
    observed.write.format("noop").mode("overwrite").save()
    value = obs.get[name]
    return df.sparkSession.createDataFrame([(name, int(value))], "name string, value bigint")


def concat_ordered(df: DataFrame, value: str, order: str, group: str | None = None,
                   chunk_width: int | None = None, alias: str = "text") -> DataFrame:
    """Concatenate ``value`` in ``order`` (a string accumulator with a defined order).

    The result is cut into groups so that no single task has to build one
    unbounded string:

    * ``group``: one string per value of that column;
    * ``chunk_width``: one string per range ``order div chunk_width`` of a
      numeric, unique ordering key, so a chunk holds at most ``chunk_width``
      values; chunks laid end to end in ``chunk`` order give the whole
      concatenation;
    * neither: a single string (for inputs of known, small size).

    Empty input gives ``""`` for the single-string form, as the accumulator
    starts empty.
    """
    if group is not None and chunk_width is not None:
        raise ValueError("give either group or chunk_width")
    agg = F.expr(f"listagg(`{value}`, '') WITHIN GROUP (ORDER BY `{order}`)")
    if chunk_width is not None:
        keyed = df.withColumn("chunk", floor_div(order, chunk_width))
        return keyed.groupBy("chunk").agg(agg.alias(alias))
    if group is not None:
        return df.groupBy(group).agg(agg.alias(alias))
    return df.agg(F.coalesce(agg, F.lit("")).alias(alias))


def concat_offsets(df: DataFrame, value: str, order: str) -> DataFrame:
    """``<order>, offset bigint, <value>``: where each value begins (in UTF-8 bytes) in the concatenation of all, in ``order``.

    The offsets are running totals over range partitions; no task sees the whole.  ``order`` must tell
    rows apart.  Null values are left out, as an accumulator adds nothing for them.
    """
    rows = df.where(F.col(value).isNotNull()).select(order, value, F.octet_length(F.col(value)).cast("bigint").alias("__bytes"))
    laid = running_totals(rows, [F.col(order).asc_nulls_first()], ["__bytes"], name="concat")
    return laid.select(order, F.col("before___bytes").alias("offset"), value)


def concat_pieces(df: DataFrame, value: str, order: str, piece_bytes: int = 1 << 20, alias: str = "text") -> DataFrame:
    """``offset bigint, <alias>``: the one accumulator string as pieces that know their place.

    A piece holds the values that begin within the same ``piece_bytes`` bytes, so it is never longer
    than these and one value; each piece laid at its offset, they are the whole concatenation.
    """
    laid = concat_offsets(df, value, order).withColumn("__piece", floor_div("offset", piece_bytes))
    text = F.expr(f"listagg(`{value}`, '') WITHIN GROUP (ORDER BY `{order}`)")
    return laid.groupBy("__piece").agg(F.min("offset").alias("offset"), text.alias(alias)).drop("__piece")
