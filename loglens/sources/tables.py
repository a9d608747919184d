"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming ``columns`` keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
