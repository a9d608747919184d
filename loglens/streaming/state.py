"""Keyed state of streams: pane windows that account for late rows, latest-wins values, timed pushes.

The state itself is the store.  Nothing that a batch has written is read back, so a
batch costs what its rows cost however long the stream has run, and what is open at
the moment is read from the checkpoint's state (:func:`read_open_windows`,
:func:`read_latest`).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from loglens.functions.logline import seen_text
from loglens.functions.numeric import floor_div
from loglens.operators.access_log import parse_access_log
from loglens.operators.windows import duration_us, pane_us, window_starts

PANE_ROWS = "kind string, ip string, at bigint, hits bigint, last_key bigint, missed int"
_PANES = "panes array<bigint>, hits array<bigint>, lasts array<bigint>, fired bigint"
_NONE = -2 ** 62


def _bounds(pane: int, width: int, size: int, step: int) -> range:
    """Starts of the windows that contain a pane."""
    return range(-(-(pane + width - size) // step) * step, pane + 1, step)


class PaneWindows(StatefulProcessor):
    """Per client: its panes' counts; a timer per client gives a window's sum when the watermark passes its end.

    A pane is kept until the last window that holds it is closed, so the state is
    the panes of one window and what the watermark still waits for.  Rows come in
    counted per pane; for each pane the windows that are closed already are its
    missed ones, and it is given out as ``late`` with their number.
    """

    def __init__(self, length: str, slide: str | None):
        self.size, self.step, self.width = duration_us(length), duration_us(slide or length), pane_us(length, slide)

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", _PANES)

    def _load(self) -> tuple[dict, int]:
        if not self.state.exists():
            return {}, _NONE
        panes, hits, lasts, fired = self.state.get()
        return {int(p): (int(h), int(k)) for p, h, k in zip(panes, hits, lasts)}, int(fired)

    def _ends(self, panes: dict, after: int) -> list[int]:
        """Ends after ``after`` of the windows that hold a pane, ascending."""
        return sorted({s + self.size for p in panes for s in _bounds(p, self.width, self.size, self.step) if s + self.size > after})

    def _closed(self, ip, panes: dict, after: int, upto: int) -> list[tuple]:
        """The windows that end in ``(after, upto]``; their sums."""
        out = []
        for end in self._ends(panes, after):
            if end > upto:
                break
            own = [v for p, v in panes.items() if end - self.size <= p < end]
            out.append(("window", ip, end - self.size, sum(h for h, _ in own), max(k for _, k in own), 0))
        return out

    def _keep(self, panes: dict, closed: int) -> None:
        """Store the panes of open windows, and wake at the end of the first of these."""
        kept = {p: v for p, v in panes.items() if _bounds(p, self.width, self.size, self.step)[-1] + self.size > closed}
        if not kept:
            self.state.clear()
            return
        at = sorted(kept)
        self.state.update((at, [kept[p][0] for p in at], [kept[p][1] for p in at], closed))
        self.handle.registerTimer(-(-self._ends(kept, closed)[0] // 1000))

    def handleInputRows(self, key, rows, timerValues):
        panes, fired = self._load()
        closed = max(timerValues.getCurrentWatermarkInMs() * 1000, fired)
        # Rows come before the timers of their batch: what the watermark has closed takes none of them.
        out = self._closed(key[0], panes, fired, closed)
        for batch in rows:
            for pane, hits, last in batch[["pane", "hits", "last_key"]].itertuples(index=False, name=None):
                starts = _bounds(pane, self.width, self.size, self.step)
                missed = sum(s + self.size <= closed for s in starts)
                if missed:
                    out.append(("late", key[0], pane, hits, last, missed))
                if missed < len(starts):
                    old = panes.get(pane, (0, _NONE))
                    panes[pane] = (old[0] + hits, max(old[1], last))
        self._keep({p: v for p, v in panes.items() if len(_bounds(p, self.width, self.size, self.step))}, closed)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        panes, fired = self._load()
        closed = max(timerValues.getCurrentWatermarkInMs() * 1000, fired)
        out = self._closed(key[0], panes, fired, closed)
        self._keep(panes, closed)
        yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [object, object, "int64", "int64", "int64", "int32"]
    return pd.DataFrame({c.split()[0]: pd.Series(list(x), dtype=k) for c, x, k in zip(PANE_ROWS.split(", "), columns, kinds)})


def _counted(batches):
    """Rows (ip, pane, last_key) counted per client and pane, batch by batch, before they are shuffled."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch]).group_by(["ip", "pane"]).aggregate([("last_key", "count"), ("last_key", "max")])
            for part in table.select(["ip", "pane", "last_key_count", "last_key_max"]).to_batches():
                yield pa.RecordBatch.from_arrays(part.columns, ["ip", "pane", "hits", "last_key"])


def pane_windows(lines: DataFrame, length: str, slide: str | None = None, watermark: str = "60 seconds") -> DataFrame:
    """A stream of access-log lines as rows ``kind, ip, at, hits, last_key, missed``; nothing is lost.

    ``window``: a closed window of a client (``at``: its start, epoch microseconds).
    ``late``: rows of a client and pane (``at``) that came after ``missed`` of their windows
    were closed; in the others they still count.  A client's hits in all windows, closed or
    open, and its late rows times the windows they missed are all its rows times the windows
    of each.  Null clients cannot occur: parsing drops such lines.
    """
    parsed = parse_access_log(lines, mode="permissive").withWatermark("ets", watermark)
    width = pane_us(length, slide)
    pane = floor_div(F.unix_micros("ets"), width) * F.lit(width)
    counted = parsed.select("ip", pane.alias("pane"), F.col("seen_key").alias("last_key")).mapInArrow(_counted, "ip string, pane bigint, hits bigint, last_key bigint")
    return counted.groupBy("ip").transformWithStateInPandas(PaneWindows(length, slide), PANE_ROWS, "Append", "EventTime")


def _flat(rows: DataFrame, start: str, length: str) -> DataFrame:
    return rows.select(floor_div(start, 10 ** 6).alias("window_start"), floor_div(F.col(start) + F.lit(duration_us(length)), 10 ** 6).alias("window_end"), "ip", "hits",
                       seen_text("last_key").alias("last_seen"))


def closed_windows(rows: DataFrame, length: str) -> DataFrame:
    """``window_start, window_end, ip, hits, last_seen`` of the ``window`` rows."""
    return _flat(rows.where("kind = 'window'"), "at", length)


def late_rows(rows: DataFrame) -> DataFrame:
    """``ip, pane bigint (epoch us), hits, last_seen, missed`` of the ``late`` rows."""
    return rows.where("kind = 'late'").select("ip", F.col("at").alias("pane"), "hits", seen_text("last_key").alias("last_seen"), "missed")


def read_open_windows(spark: SparkSession, checkpoint: str, length: str, slide: str | None = None) -> DataFrame:
    """The windows that are open as of the last batch, from the state of :func:`pane_windows`, like :func:`closed_windows`."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "panes").load()
    own = state.select(F.col("key.ip").alias("ip"), F.col("value.fired").alias("fired"),
                       F.explode(F.arrays_zip("value.panes", "value.hits", "value.lasts")).alias("p"))
    each = own.select("ip", "fired", F.col("p.hits").alias("hits"), F.col("p.lasts").alias("last_key"), F.explode(window_starts(F.col("p.panes"), length, slide)).alias("start"))
    still = each.where(F.col("start") + F.lit(duration_us(length)) > F.col("fired"))
    return _flat(still.groupBy("start", "ip").agg(F.sum("hits").alias("hits"), F.max("last_key").alias("last_key")), "start", length)


class LatestWins(StatefulProcessor):
    """Per key: the value of the greatest version (ties: the greater value), optionally forgotten ``ttl_ms`` after its last change."""

    def __init__(self, value_type: str, ttl_ms: int | None = None):
        self.value_type, self.ttl_ms = value_type, ttl_ms

    def init(self, handle) -> None:
        self.latest = handle.getValueState("latest", f"version bigint, value {self.value_type}", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        old = tuple(self.latest.get()) if self.latest.exists() else None
        new = old
        for batch in rows:
            for version, value in zip(batch["version"].tolist(), batch["value"].tolist()):
                new = max(new, (version, value)) if new is not None else (version, value)
        if new != old:
            self.latest.update(new)
            yield pd.DataFrame({"key": [key[0]], "version": np.array([new[0]], "int64"), "value": [new[1]]})

    def close(self) -> None:
        pass


def latest_wins(stream: DataFrame, key: str, version: str, value: str, ttl_ms: int | None = None) -> DataFrame:
    """The changes ``key, version bigint, value`` of a latest-wins store; rows with a null in any of the three are left out.

    Every task first keeps one row per key and batch, so a hot key sends few.  With
    ``ttl_ms`` a value that does not change so long is forgotten (processing time).
    """
    kinds = dict(stream.dtypes)
    rows = stream.select(F.col(key).alias("key"), F.col(version).cast("bigint").alias("version"), F.col(value).alias("value")).dropna()

    def newest(batches):
        for batch in batches:
            if batch.num_rows:
                order = pa.Table.from_batches([batch]).sort_by([("key", "ascending"), ("version", "descending"), ("value", "descending")]).combine_chunks()
                coded = order.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
                first = np.ones(len(coded), bool)
                first[1:] = coded[1:] != coded[:-1]
                yield from order.filter(pa.array(first)).to_batches()

    fewer = rows.mapInArrow(newest, f"key {kinds[key]}, version bigint, value {kinds[value]}")
    mode = "None" if ttl_ms is None else "ProcessingTime"
    return fewer.groupBy("key").transformWithStateInPandas(LatestWins(kinds[value], ttl_ms), f"key {kinds[key]}, version bigint, value {kinds[value]}", "Update", mode)


def read_latest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``key, version, value``: all values of :func:`latest_wins` as of the last batch, from its state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "latest").load()
    value = "value.value" if "ttlExpirationMs" in state.select("value.*").columns else "value"
    return state.select(F.col("key.key").alias("key"), F.col(f"{value}.version").alias("version"), F.col(f"{value}.value").alias("value"))


class NewestPush(StatefulProcessor):
    """The newest message that has come in, given out at most once per interval; older ones are dropped."""

    def __init__(self, interval_ms: int):
        self.interval_ms = interval_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "window_end bigint, message string")
        self.pushed = handle.getValueState("pushed", "window_end bigint, due bigint")

    def handleInputRows(self, key, rows, timerValues):
        pushed, due = tuple(self.pushed.get()) if self.pushed.exists() else (_NONE, _NONE)
        best = tuple(self.waiting.get()) if self.waiting.exists() else None
        idle = best is None
        for batch in rows:
            for new in zip(batch["window_end"].tolist(), batch["message"].tolist()):
                if new[0] > pushed and (best is None or new > best):
                    best = new
        if best is not None:
            self.waiting.update(best)
            if idle:  # the first after a push waits for the rest of the interval
                now = timerValues.getCurrentProcessingTimeInMs()
                self.handle.registerTimer(max(due, now + 1))
        yield _push([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out = []
        if self.waiting.exists():
            end, message = self.waiting.get()
            out.append((end, message))
            self.pushed.update((end, timerValues.getCurrentProcessingTimeInMs() + self.interval_ms))
            self.waiting.clear()
        yield _push(out)

    def close(self) -> None:
        pass


def _push(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({"window_end": pd.Series([r[0] for r in rows], dtype="int64"), "message": pd.Series([r[1] for r in rows], dtype=object)})


def newest_push(snapshots: DataFrame, interval_ms: int = 1000) -> DataFrame:
    """A stream of ``window_end, message`` as the pushes: the newest window not pushed yet, at most one per interval.

    One key holds the state, which is one message; the input has one message per
    batch of the job that makes the snapshots, not its rows.
    """
    rows = snapshots.select(F.lit(0).alias("all"), "window_end", "message").where("window_end is not null and message is not null")
    return rows.groupBy("all").transformWithStateInPandas(NewestPush(interval_ms), "window_end bigint, message string", "Append", "ProcessingTime")
