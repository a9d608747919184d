"""User code as predicates and aggregates, on the Arrow-batched paths.

Built-in expressions come first (see :mod:`loglens.operators.filters`);
these helpers are for logic that only exists as Python.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def check_serializable(obj, what: str = "function") -> None:
    """Fail early, with a clear message, if ``obj`` cannot be shipped to executors.

    Spark pickles the closure of a UDF when the plan is built; anything it
    captures (a lock, an open file, a client) must be picklable or left out.
    """
    try:
        cloudpickle.dumps(obj)
    except Exception as exc:  # pickling raises many types
        raise TypeError(f"{what} cannot be serialized for the executors: {exc}") from exc


def series_predicate_udf(fn: Callable[[pd.Series], pd.Series]):
    """Wrap a vectorised predicate (Series to boolean Series) as a ``pandas_udf``; the first choice."""
    check_serializable(fn, "predicate")

    @F.pandas_udf(BooleanType())
    def _pred(s: pd.Series) -> pd.Series:
        return fn(s).astype("boolean")

    return _pred


def predicate_udf(fn: Callable[[str], bool]):
    """Wrap a Python row predicate as an Arrow-batched ``pandas_udf``, called row by row."""
    check_serializable(fn, "predicate")

    @F.pandas_udf(BooleanType())
    def _pred(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else bool(fn(v))).astype("boolean")

    return _pred


def regex_predicate_udf(regex: str):
    """Vectorised whole-match predicate (``String.matches``) as a ``pandas_udf``.

    ``re.ASCII`` keeps ``\\d`` and ``\\w`` to ASCII, as in JVM regexes.
    """
    compiled = re.compile(regex, re.ASCII)

    @F.pandas_udf(BooleanType())
    def _matches(s: pd.Series) -> pd.Series:
        return s.str.fullmatch(compiled).astype("boolean")

    return _matches


def filter_with_partition_resource(df: DataFrame, column: str,
                                   make_resource: Callable[[], object],
                                   test: Callable[[object, pd.Series], pd.Series]) -> DataFrame:
    """Filter rows with a resource that cannot be serialized.

    ``make_resource`` runs once per task on the executor (the ``@transient``
    field of a JVM class, rebuilt where it is used); ``test(resource,
    series)`` returns a boolean mask per Arrow batch.  Only the factory is
    shipped, so it must be picklable itself.
    """
    check_serializable(make_resource, "resource factory")
    check_serializable(test, "test")

    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = make_resource()
        for pdf in batches:
            mask = test(resource, pdf[column]).fillna(False).astype(bool)
            yield pdf[mask.to_numpy()]

    return df.mapInPandas(per_partition, schema=df.schema)


#: Tasks that a group's states are spread over between the rows' tasks and the last one.
SPREAD = 64
#: States that a task holds before it sends them on.
HELD = 10_000
_NAN = float("nan")


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)  # a NaN key equals itself


def _reduced(group: str, columns: list[str], zero, add, add_batch, key_type: pa.DataType):
    """Arrow batches -> one state per group, salted by the task."""

    def run(batches):
        salt = TaskContext.get().partitionId() % SPREAD
        states: dict = {}

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(list(states), key_type), pa.array([salt] * len(states), pa.int32()),
                                               pa.array([pickle.dumps(x) for x in states.values()], pa.binary())], [group, "salt", "state"])
            states.clear()
            return rows

        for batch in batches:
            coded = batch.column(group).dictionary_encode(null_encoding="encode")
            keys, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(keys)))
            for key, lo, hi in zip(keys, [0, *ends], ends):
                own = [batch.column(c).take(pa.array(order[lo:hi])) for c in columns]
                key = _NAN if key != key else key  # one object, so that the dict finds it again
                state = states.get(key, states)
                state = zero() if state is states else state
                if add_batch is not None:
                    state = add_batch(state, *own)
                else:
                    for row in zip(*(x.to_pylist() for x in own)):
                        state = add(state, *row)
                states[key] = state
            if len(states) > HELD:
                yield flush()
        if states:
            yield flush()

    return run


def _combined(group: str, merge, finish, names: list[str], kinds: list[pa.DataType]):
    """States sorted by group -> one row per group: what ``finish(state)`` gives, one state in memory at a time."""

    def run(batches):
        now, state, some = None, None, False
        for batch in batches:
            out = []
            salts = batch.column("salt").to_pylist()
            for key, salt, raw in zip(batch.column(group).to_pylist(), salts, batch.column("state").to_pylist()):
                if some and _same(key, now[0]) and salt == now[1]:
                    state = merge(state, pickle.loads(raw))
                else:
                    if some:
                        out.append((*now, finish(state)))
                    now, state, some = (key, salt), pickle.loads(raw), True
            yield rows_of(out)
        if some:
            yield rows_of([(*now, finish(state))])

    def rows_of(out):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return run


def user_aggregate(df: DataFrame, group: str, columns: list[str], out: str, zero: Callable[[], object],
                   add: Callable | None, merge: Callable, value: Callable, add_batch: Callable | None = None) -> DataFrame:
    """A user-defined aggregate per group: ``<group>, <alias>`` with ``out`` like ``"text string"``.

    ``zero()`` starts a state, ``add(state, *values)`` takes in a row or
    ``add_batch(state, *arrow_arrays)`` all rows of a group in an Arrow batch at once,
    ``merge(state, state)`` joins two and ``value(state)`` gives the result.  Values and
    keys are Arrow's, so 64-bit integers and nulls are exact; rows of a null key are a group,
    as are rows whose key is NaN.

    States are merged in a tree: a task reduces its rows to one pickled state per group,
    ``SPREAD`` tasks per group merge those, one after the other, and only what these give
    meets in one task.  Rows come in no particular order: ``merge`` must be associative
    and commutative.
    """
    for fn, what in ((zero, "zero"), (add, "add"), (add_batch, "add_batch"), (merge, "merge"), (value, "value")):
        check_serializable(fn, what)
    if (add is None) == (add_batch is None):
        raise ValueError("give either add or add_batch")
    field, alias = df.schema[group], out.split()[0]
    key_type = df.select(F.col(group)).limit(0).toArrow().schema.field(0).type
    kind = df.sparkSession.createDataFrame([], out).toArrow().schema.field(0).type
    own = df.select(group, *columns)
    if field.dataType.simpleString() in ("double", "float"):
        own = own.withColumn(group, F.when(F.col(group) == 0, F.lit(0.0).cast(field.dataType)).otherwise(F.col(group)))
    names, kinds = [group, "salt", "state"], [key_type, pa.int32(), pa.binary()]
    schema = f"`{group}` {field.dataType.simpleString()}, salt int, state binary"
    states = own.mapInArrow(_reduced(group, columns, zero, add, add_batch, key_type), schema)
    fewer = states.repartition(group, "salt").sortWithinPartitions(group, "salt").mapInArrow(_combined(group, merge, pickle.dumps, names, kinds), schema)
    last = fewer.withColumn("salt", F.lit(0)).repartition(group).sortWithinPartitions(group)
    done = last.mapInArrow(_combined(group, merge, value, [group, "salt", alias], [key_type, pa.int32(), kind]), f"`{group}` {field.dataType.simpleString()}, salt int, {out}")
    return done.drop("salt")


def concat_udaf(df: DataFrame, value: str, order: str, group: str, alias: str = "text") -> DataFrame:
    """Ordered concatenation per group as a user aggregate; a state holds its group's values, so groups must be bounded."""
    return user_aggregate(
        df, group, [order, value], f"{alias} string", zero=list,
        add=lambda state, at, text: state if text is None else state + [(at, str(text))],
        merge=lambda a, b: a + b, value=lambda state: "".join(text for _, text in sorted(state)))


def span_udaf(df: DataFrame, column: str, group: str, alias: str = "span") -> DataFrame:
    """Greatest minus smallest value per group as a user aggregate; null for a group without values."""
    def add_batch(state, values):
        found = pc.min_max(values)
        low, high = found["min"].as_py(), found["max"].as_py()
        return state if low is None else (low, high) if state is None else (min(state[0], low), max(state[1], high))

    return user_aggregate(
        df, group, [column], f"{alias} bigint", zero=lambda: None, add=None, add_batch=add_batch,
        merge=lambda a, b: b if a is None else a if b is None else (min(a[0], b[0]), max(a[1], b[1])),
        value=lambda state: None if state is None else state[1] - state[0])
