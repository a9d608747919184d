"""Event counts per fixed time slot, with empty slots reported as zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglens.functions.numeric import floor_div
from loglens.operators.scan import running_totals

SPAN = 1 << 16  # quiet slots written out at once

# Fixed value: the per-slot message (the job printed one per batch).
MESSAGE_FORMAT = "received %d events"


def count_message(n) -> Column:
    """``received <n> events`` for a count column."""
    return F.format_string(MESSAGE_FORMAT, n)


def tumbling_counts(df: DataFrame, ts: str, width_seconds: int) -> DataFrame:
    """``window_start bigint (epoch s), n bigint, message string``, one row per slot.

    Slots are ``[k * width, (k + 1) * width)`` seconds since the epoch, read
    as UTC.  Counting is a partial + final aggregate.  The busy slots, which are
    few, are numbered in order over range partitions, so each finds the next one by
    an equi join and brings the quiet slots up to it; no task sees all of them.  A long gap,
    as before a wrong time far away, is cut into spans of SPAN slots, which are
    spread over tasks before they are written out.  Rows without a time are counted in
    a slot whose start is NULL.
    """
    slot = F.floor(F.unix_timestamp(F.col(ts)) / F.lit(width_seconds))
    counts = df.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_totals(counts, [F.col("slot").asc_nulls_first()], ["one"], name="slots")
    following = ranked.select((F.col("before_one") - 1).alias("before_one"), F.col("slot").alias("after"))
    busy = ranked.join(following, "before_one", "left").select("slot", "n", F.coalesce("after", F.col("slot") + 1).alias("after"))
    # the null slot comes first and has no quiet slots behind it
    spans = F.when(F.col("slot").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), floor_div(F.col("after") - F.col("slot") - 1, SPAN)))
    cut = busy.select("slot", "n", "after", F.explode(spans).alias("span")).repartition("slot", "span")
    first = F.col("slot") + F.col("span") * SPAN
    each = F.when(F.col("slot").isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(F.sequence(first, F.least(first + SPAN, F.col("after")) - 1))
    filled = cut.select("slot", "n", F.explode(each).alias("at"))
    n = F.when(F.col("at").eqNullSafe(F.col("slot")), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    return filled.select((F.col("at") * F.lit(width_seconds)).alias("window_start"),
                         n.alias("n"), count_message(n).alias("message"))
