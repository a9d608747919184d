"""``foreachBatch`` sinks: idempotent per batch, resolved latest-wins on read.

A micro-batch may be replayed after a failure with the same ``batch_id``;
every sink here overwrites the folder of that id, so a replay replaces
rather than duplicates.  Update mode emits a group again each time it
changes; reading keeps, per key, the row of the highest batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.operators.counts import count_message
from loglens.operators.snapshot import newest_window, snapshot_message
from loglens.operators.windows import leaderboard, project_windows

# Layout of the upsert log: <out>/batch_id=<n>/*.parquet
_UPSERT_SCHEMA = ("window_start bigint, window_end bigint, ip string, hits bigint, "
                  "last_seen string, batch_id bigint")
_SNAPSHOT_SCHEMA = "window_end bigint, message string, batch_id bigint"


def _read_batches(spark: SparkSession, out_dir: str, schema: str) -> DataFrame:
    """What a sink has written; no rows if no batch has written anything yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out_dir)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out_dir)


def _batch_path(out_dir: str, batch_id: int) -> str:
    return f"{out_dir.rstrip('/')}/batch_id={batch_id}"


def _updated_rows(batch: DataFrame, min_hits: int | None) -> DataFrame:
    rows = project_windows(batch)
    if min_hits is not None:
        rows = rows.where(F.col("hits") >= F.lit(min_hits))
    return rows


def _write_upserts(rows: DataFrame, out_dir: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_batch_path(out_dir, batch_id))


def window_upsert_sink(out_dir: str, min_hits: int | None = None
                       ) -> Callable[[DataFrame, int], None]:
    """Sink for the windowed hits stream: updated ``(window, ip)`` rows per batch."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        _write_upserts(_updated_rows(batch, min_hits), out_dir, batch_id)
    return sink


def read_window_upserts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Current value of every ``(window_start, ip)``: the row of its latest batch.

    ``max_by`` is an aggregate with a partial step, so a key updated in many
    batches is reduced map-side.
    """
    rows = _read_batches(spark, out_dir, _UPSERT_SCHEMA)
    latest = F.max_by(F.struct("hits", "last_seen"), "batch_id").alias("v")
    return (rows.groupBy("window_start", "window_end", "ip").agg(latest)
                .select("window_start", "window_end", "ip",
                        F.col("v.hits").alias("hits"), F.col("v.last_seen").alias("last_seen")))


def leaderboard_sink(snap_dir: str, n: int = 50, by: str = "hits",
                     min_hits: int | None = None) -> Callable[[DataFrame, int], None]:
    """Rank the windows that a batch closed and store the newest as a JSON snapshot.

    For append mode: a window arrives once, whole, when the watermark passes
    its end, so a message always covers a full window and nothing is read
    back.  The message is written per ``batch_id`` (idempotent); a batch that
    closes no window writes nothing.  :func:`read_latest_snapshot` picks the
    newest window.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = _updated_rows(batch, min_hits).persist()
        try:
            if not rows.isEmpty():
                (snapshot_message(newest_window(leaderboard(rows, n, by)))
                    .write.mode("overwrite").parquet(_batch_path(snap_dir, batch_id)))
        finally:
            rows.unpersist()
    return sink


def read_latest_snapshot(spark: SparkSession, snap_dir: str) -> DataFrame:
    """``window_end, message`` of the newest window published, from its last batch; no row before the first."""
    snaps = _read_batches(spark, snap_dir, _SNAPSHOT_SCHEMA)
    newest = F.max(F.struct("window_end", "batch_id", "message")).alias("s")
    return snaps.agg(newest).where("s is not null").select("s.window_end", "s.message")


def print_values(column: str = "value") -> Callable[[DataFrame, int], None]:
    """Sink printing every value of a batch, one line each, with one partition on the driver at a time."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        for row in batch.select(column).toLocalIterator():
            print(row[0])
    return sink


def batch_count_sink(out_dir: str) -> Callable[[DataFrame, int], None]:
    """Sink writing ``batch_id, n, message`` for every micro-batch, also empty ones."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        n = batch.agg(F.count(F.lit(1)).alias("n"))
        (n.select("n", count_message(F.col("n")).alias("message"))
          .write.mode("overwrite").parquet(_batch_path(out_dir, batch_id)))
    return sink


def read_batch_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    return _read_batches(spark, out_dir, "n bigint, message string, batch_id bigint").select("batch_id", "n", "message")


def snapshot_stream(spark: SparkSession, snap_dir: str) -> DataFrame:
    """The messages of :func:`leaderboard_sink`, as they are written, as a stream of ``window_end, message``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(snap_dir)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return spark.readStream.schema(_SNAPSHOT_SCHEMA).parquet(snap_dir).select("window_end", "message")


def read_pushes(spark: SparkSession, path: str) -> DataFrame:
    """``window_end, message`` of every push written so far."""
    return _read_batches(spark, path, "window_end bigint, message string")
