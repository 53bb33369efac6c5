"""The corpus pipeline: quality, exact copies, near copies, contamination, tokens, each stage on what the last one kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that `run` writes as Parquet and reads again. All but the
last return the columns of `documents`. Null texts count as empty, repeated rows as copies (exact dedup keeps one of
them), an empty table passes as an empty table, and extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from strataflow.llm.common import shared_table, small_batches
from strataflow.llm.contamination import drop_contaminated
from strataflow.llm.exact import drop_exact
from strataflow.llm.near import drop_near
from strataflow.llm.pieces import round_trip
from strataflow.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text passes their language's threshold."""
    small_batches(spark)
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal but for white space: the longest, then the smallest id."""
    small_batches(spark)
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    small_batches(spark)
    return drop_near(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of benchmark words."""
    small_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, their number, and whether they decode to its text."""
    small_batches(spark)
    return round_trip(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

#: The trained model of the first stage and the last stage's ids are beyond SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return shared_table(stage(spark, docs, sf_dir), name)
