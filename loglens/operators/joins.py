"""Equi-join to a lookup table when a few keys carry a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_split_join(big: DataFrame, lookup: DataFrame, key: str, weight: str,
                   hot_fraction: float = 1e-3, total=None) -> DataFrame:
    """Inner join ``big`` to ``lookup`` (unique on ``key``) with hot keys split off.

    ``weight`` is a non-negative column of ``lookup`` that bounds how many
    rows of ``big`` a key has (for a frequency table: the frequency).  Keys
    holding at least ``hot_fraction`` of the total weight are hot; there can
    be at most ``1 / hot_fraction`` of them, which is the proven size bound
    that lets them be broadcast.  Rows of hot keys join map-side against
    that small table and never enter a shuffle; the remaining rows are
    filtered map-side and take an ordinary shuffle join, where no key has
    more than ``hot_fraction`` of the weight.  (Keys of weight 0 are never
    hot, so the bound holds even when the total is 0.)  ``total`` is the
    sum of ``weight`` if the caller has a cheaper way to it (a column, e.g.
    a scalar subquery); by default it is summed from ``lookup``.
    """
    if not 1e-4 <= hot_fraction <= 1:
        raise ValueError("hot_fraction must be from 0.0001 to 1: it bounds the broadcast side to 1 / hot_fraction keys")
    if total is None:
        total = lookup.agg(F.sum(F.col(weight)).alias("w")).scalar()
    is_hot = (F.col(weight) > F.lit(0)) & (F.col(weight) >= total * F.lit(hot_fraction))
    hot = lookup.where(is_hot)
    cold = lookup.where(~F.coalesce(is_hot, F.lit(False)))
    # A map-side lookup tags every row with its hot-key match (if any): the
    # matched rows are complete without a shuffle, the rest go to the
    # shuffle join.
    hot_side = hot.select(F.col(key), *[F.col(c).alias(f"__hot_{c}") for c in lookup.columns
                                        if c != key])
    tagged = big.join(F.broadcast(hot_side), key, "left")
    marker = f"__hot_{weight}"
    via_broadcast = tagged.where(F.col(marker).isNotNull()).select(
        *big.columns, *[F.col(f"__hot_{c}").alias(c) for c in lookup.columns if c != key])
    via_shuffle = (tagged.where(F.col(marker).isNull()).select(*big.columns)
                         .join(cold, key, "inner"))
    return via_broadcast.unionByName(via_shuffle)
