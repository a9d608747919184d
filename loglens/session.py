"""Session defaults and the shared staging folder.

Nothing here overrides a setting the cluster already made: defaults are
applied only where a key is unset, so a spark-submit configuration wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a Spark user sets for this kind of job.  AQE re-plans joins and
# coalesces small shuffle partitions at run time, and splits skewed join
# partitions; the file split size bounds the memory one scan task needs.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Settings read only when the JVM starts.
STATIC_DEFAULTS = {"spark.ui.enabled": "false"}

# Bytes one reducer should receive; see shuffle_partitions_for().
TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, minimum: int = 200) -> int:
    """A ``spark.sql.shuffle.partitions`` for a job shuffling ``shuffle_bytes``.

    AQE only coalesces partitions (and splits skewed join partitions), it
    never raises their number, so the setting must fit the largest
    shuffle: about 256 MB per reducer.  At 100 TB of input with a shuffle
    of a tenth of it that is some 40 000 partitions; small runs are
    coalesced back by AQE.
    """
    return max(minimum, -(-shuffle_bytes // TARGET_SHUFFLE_PARTITION_BYTES))


def build_session(master: str | None = None, app_name: str = "loglens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Get or create a session; defaults fill only keys the cluster left unset.

    ``master`` is only used when given (tests, bench); on a cluster the
    launcher decides.  ``extra`` and ``shuffle_partitions`` are explicit and
    always applied.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in STATIC_DEFAULTS.items():
        builder = builder.config(key, value)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in explicit.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in explicit and not cluster.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system such as HDFS or an
    object store).  Only a local-mode session without it (tests) gets a
    fresh folder under the temp directory.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS, object store) before running staged or streaming jobs")
        root = tempfile.mkdtemp(prefix="loglens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def staging_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root for one run."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str):
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage in one pass: a later failure re-reads the table
    instead of recomputing its inputs, and several consumers of the result
    scan it instead of each recomputing it.  (``DataFrame.checkpoint``
    needs a second job to write unless its input is cached.)
    """
    path = staging_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
