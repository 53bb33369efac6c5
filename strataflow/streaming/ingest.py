"""Consume append-only file streams exactly once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import read_csv_text, typed_or_rejected
from ..sources.sinks import write_batch


@dataclass(frozen=True)
class RunResult:
    rows_in: int
    rows_out: int
    batches: int

    @property
    def had_data(self) -> bool:
        return self.batches > 0


def parquet_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Stream of the files of a folder; a new checkpoint starts with the rows already there."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def _run(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hands every new micro-batch to `write` and stops; the checkpoint is the stream's offset."""
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def consume(
    stream: DataFrame, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> RunResult:
    """Process what is new and stop.

    Each micro-batch lands in the folder of its batch id, so a batch that is run again after a failure replaces itself.
    """
    seen = {"in": 0, "out": 0, "batches": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        source, result = Observation(), Observation()
        rows = batch.observe(source, F.count(F.lit(1)).alias("n"))
        rows = transform(rows) if transform else rows
        write_batch(rows.observe(result, F.count(F.lit(1)).alias("n")), sink, batch_id)
        seen["in"] += source.get["n"]
        seen["out"] += result.get["n"]
        seen["batches"] += 1

    _run(stream, checkpoint, write)
    return RunResult(seen["in"], seen["out"], seen["batches"])


def ingest_csv(
    spark: SparkSession, folder: str, schema: StructType | str, target: str, rejects: str, checkpoint: str
) -> RunResult:
    """Continuous ingestion of a CSV folder: each file is read once, good rows land typed, bad rows as text.

    A micro-batch is parsed into the cache (memory, then disk) and written from there to both places under its batch id;
    a part of the cache that is lost with its executor is read again, and a batch that is repeated replaces itself.
    """
    text = read_csv_text(spark, folder, schema, stream=True)
    seen = {"in": 0, "out": 0, "batches": 0}

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = Observation()
        rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
        good, bad = typed_or_rejected(rows, schema)
        write_batch(good.observe(kept, F.count(F.lit(1)).alias("n")), target, batch_id)
        write_batch(bad, rejects, batch_id)
        seen["in"] += rows.count()
        seen["out"] += kept.get["n"]
        seen["batches"] += 1
        rows.unpersist()

    _run(text, f"{checkpoint}/rows", write)
    return RunResult(seen["in"], seen["out"], seen["batches"])
