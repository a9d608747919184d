"""Running totals in a global order, without a task that sees a whole group.

A window function brings every row of a group, or without groups every row, into
one task.  Here rows are range-partitioned by their order, each task adds up its
own part, and what lies before a part is one small row per part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglens.session import materialize


def _local(group: str, sums: list[str], names: list[str]):
    """Per batch of a sorted part: the totals before each row within the part, and whether the row is of the part's first group."""

    def run(batches):
        part = TaskContext.get().partitionId()
        last, carry, first, started = None, np.zeros(len(sums), np.int64), None, False
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = batch.column(group)
            code = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            head = np.ones(n, bool)
            head[1:] = code[1:] != code[:-1]
            if not started:
                first, started = column[0].as_py(), True
            elif column[0].as_py() == last:
                head[0] = False
            start = np.flatnonzero(head)
            run_of = np.cumsum(head)  # 0: goes on from the batch before
            out = []
            for k, name in enumerate(sums):
                x = batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                before = np.cumsum(x) - x
                base = np.concatenate([[-carry[k]], before[start]])
                out.append(before - base[run_of])
                carry[k] = out[-1][-1] + x[-1]
            last = column[n - 1].as_py()
            # Sorted rows: the first group is what comes before the first change.
            is_first = np.zeros(n, bool)
            if last == first:
                is_first[:] = True
            elif column[0].as_py() == first:
                is_first[:int(np.argmax(code != code[0]))] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in out), pa.array(np.full(n, part, np.int32)), pa.array(is_first)], names)

    return run


def running_totals(df: DataFrame, order: list, sums: list[str], group: str | None = None, name: str = "scan") -> DataFrame:
    """``df`` with ``before_<c>`` for each bigint column of ``sums``: the total of the rows before, in ``order``, of the same group.

    ``order`` must tell all rows apart that may not be swapped; rows equal in it are of one part.
    Nulls count as 0; rows of a null group are a group.  Totals must stay below 2 ** 63.
    The result is a written table (in the shared checkpoint folder), in no particular row order.
    What is broadcast has one row per part at most, so it is bounded by the number of shuffle partitions.
    """
    key, part, first = "__scan_group", "__scan_part", "__scan_first"
    own = df.withColumn(key, F.col(group) if group else F.lit(0))
    by = [F.col(key).asc_nulls_first(), *order]
    names = [*own.columns, *(f"before_{c}" for c in sums), part, first]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in own.dtypes), *(f"`before_{c}` bigint" for c in sums), f"{part} int, {first} boolean"])
    parts = materialize(own.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_local(key, sums, names), schema), name)
    heads = parts.where(first).groupBy(part).agg(F.first(key).alias(key))
    again = F.broadcast(heads.select(F.col(key).alias("__scan_key")).distinct())
    totals = parts.join(again, F.col(key).eqNullSafe(F.col("__scan_key")), "left_semi").groupBy(key, part).agg(*(F.sum(c).alias(c) for c in sums))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(key).alias("__scan_key"), F.col(part).alias("__scan_at"), *(F.sum(c).over(before).alias(f"__scan_{c}") for c in sums))
    same = F.col(first) & (F.col(part) == F.col("__scan_at")) & F.col(key).eqNullSafe(F.col("__scan_key"))
    joined = parts.join(F.broadcast(carried), same, "left")
    added = {f"before_{c}": F.col(f"before_{c}") + F.coalesce(F.col(f"__scan_{c}"), F.lit(0)) for c in sums}
    return joined.withColumns(added).select(*df.columns, *(f"before_{c}" for c in sums))
