"""Exact integer helpers (no detour through double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value, n: int) -> Column:
    """``floor(value / n)`` for integral columns, exact for every ``bigint``.

    ``value / n`` goes through ``double`` and loses precision above 2**53.
    Integral ``div`` is exact but truncates toward zero, so the non-negative
    remainder is subtracted first to round toward minus infinity.
    """
    v = F.col(value) if isinstance(value, str) else value
    k = F.lit(n).cast("bigint")
    return F.call_function("div", v - F.pmod(v, k), k)
