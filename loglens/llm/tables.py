"""Reading the given tables and staging intermediate ones (helpers of the operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglens.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One given table, with only the named columns read."""
    bounded_batches(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


#: Bytes of one Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches of whole texts by bytes, where the session still has Spark's own default (64 MB).

    A batch is held by the JVM, in flight and by the worker at once, for every task of an executor.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key) and spark.conf.get(key) in ("67108864", "67108864b", "64MB"):
        spark.conf.set(key, str(BATCH_BYTES))


class Staged:
    """Tables written once to the shared checkpoint folder; old ones can be dropped early.

    Reading a staged table again costs no recomputation, and a lost executor
    loses nothing of it.
    """

    def __init__(self, df: DataFrame, name: str):
        self.df = materialize(df, name)
        self.spark = df.sparkSession

    def drop(self) -> None:
        """Delete the files, once nothing reads them any more."""
        jvm = self.spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in self.df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
