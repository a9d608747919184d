"""Training-data pipeline over ``documents``: five stages, each on what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglens.llm import bpe, decontaminate, minhash, quality, toxicity
from loglens.llm.tables import bounded_batches, table
from loglens.session import materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine scores below the threshold; it learns from labelled rows that are not held out."""
    bounded_batches(spark)
    model = toxicity.train(docs.where(~toxicity.held_out("doc_id")), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.drop_toxic(docs, model)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rules and the adaptive thresholds of their language and source."""
    return quality.drop_poor(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group (5-word shingles, similarity 0.8)."""
    return minhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids, their number, and the text as decoded from the ids."""
    # Staged, so that a task has one Python worker at a time; the ids take the text's place, which is not sent back.
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), out_col="text").withColumnRenamed("text", "ids")
    both = bpe.decode(materialize(encoded, "token-ids"), out_col="decoded")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("MinHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE encoding and decoding", tokens_stage),
]

#: SQL cannot express the toxicity stage; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
