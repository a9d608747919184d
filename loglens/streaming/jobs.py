"""Structured Streaming jobs: the batch transforms on ``readStream``.

Sources are replayable (files, Kafka), so the checkpoint plus an
idempotent sink give exactly-once results across restarts and lost
executors.  Sorts, ranks and limits are not allowed on a stream; they run
on the sink's output (a static table).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from loglens.operators.access_log import parse_access_log
from loglens.operators.windows import window_aggregate


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files under ``path`` (folder or glob) as ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (development only: not replayable, no fault tolerance)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def windowed_hits(lines: DataFrame, length: str, slide: str, watermark: str | None = "60 seconds",
                  time: str = "event") -> DataFrame:
    """Streaming ``window, ip, hits`` and last-seen aggregate of access-log lines.

    Sinks flatten it with :func:`loglens.operators.project_windows`.

    With event time the watermark bounds the state: a window is closed and
    forgotten once the watermark passes its end, and rows for it arriving
    later are dropped (and counted by Spark as dropped).
    """
    parsed = parse_access_log(lines, mode="permissive", time=time)
    if watermark:
        parsed = parsed.withWatermark("ets", watermark)
    return window_aggregate(parsed, length, slide)


@contextmanager
def _session_conf(spark: SparkSession, settings: dict[str, str]):
    """Run a block with some session settings changed (restored after)."""
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


# Fixed value: Spark's built-in state store keeping state in RocksDB on local
# disk (snapshots go to the checkpoint), instead of in the executor heap.
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
                  output_mode: str = "update", timeout_s: float | None = None,
                  state_partitions: int | None = None, state_store: str = "rocksdb") -> None:
    """Process everything available now and stop; rerun to pick up new input.

    Reusing ``checkpoint`` resumes from the committed offsets and state.
    ``state_partitions`` (default: the session's shuffle partitions) is
    recorded in a new checkpoint and kept for its life, so size it for the
    state the stream will hold, not for the cluster it starts on.
    ``state_store`` is ``"rocksdb"`` (state on local disk, snapshots in the
    checkpoint) or ``"memory"`` (the executor heap, for small state).
    """
    settings = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store == "rocksdb":
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    elif state_store != "memory":
        raise ValueError(f"state_store must be 'rocksdb' or 'memory', not {state_store!r}")
    with _session_conf(stream.sparkSession, settings):
        q = (stream.writeStream.foreachBatch(sink).outputMode(output_mode)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
    _finish(q, timeout_s)


def run_to_files(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                 state_partitions: int | None = None, timeout_s: float | None = None) -> None:
    """Like :func:`run_available` with Spark's parquet sink (exactly once, its log of files is compacted) or, in update mode, none.

    Without a sink only the state is kept, for a reader of the state.  A stream with processing-time
    timers or time-to-live never runs dry: see :func:`push_for`.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _session_conf(stream.sparkSession, settings):
        q = writer.format("parquet").start(path) if output_mode == "append" else writer.format("noop").start()
    _finish(q, timeout_s)


def _finish(q, timeout_s: float | None) -> None:
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming query did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def push_for(stream: DataFrame, path: str, checkpoint: str, seconds: float, until: Callable[[], bool] | None = None,
             trigger: str = "200 milliseconds", output_mode: str = "append") -> None:
    """Run a stream with processing-time timers into parquet files under ``path`` for ``seconds``, or until ``until()`` holds.

    Such a stream never runs dry: its timers need batches without rows.
    """
    with _session_conf(stream.sparkSession, {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER, "spark.sql.shuffle.partitions": "1"}):
        writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(processingTime=trigger)
        q = writer.format("parquet").start(path) if output_mode == "append" else writer.format("noop").start()
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end and q.isActive and not (until and until()):
            time.sleep(0.1)
    finally:
        q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def to_console(stream: DataFrame, num_rows: int = 10, processing_time: str | None = None,
               checkpoint: str | None = None, output_mode: str = "append"):
    """Print the first ``num_rows`` rows of every micro-batch (a debugging sink).

    ``processing_time`` sets the batch interval (e.g. ``"5 seconds"``); without
    it the query processes what is available and stops.
    """
    writer = (stream.writeStream.format("console").option("numRows", str(num_rows))
                    .option("truncate", "false").outputMode(output_mode))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()


def event_stream(spark: SparkSession, data_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The ``events`` table as a stream, read where it is, a bounded number of files per batch."""
    path = f"{data_dir.rstrip('/')}/events.parquet"
    # As a pattern the path may be one file as well as a folder of files.
    return (spark.readStream.schema(spark.read.parquet(path).schema)
                 .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(f"{path[:-1]}[t]"))
