"""Event-time windows over streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import top_n_per_group
from ..sources.sinks import folders, read_batches, same_key, write_batch

DAY, BATCH = "_day", "_batch_id"


def in_windows(rows: DataFrame, ts: str, length: str, slide: str | None) -> DataFrame:
    """Rows with the event-time windows they fall into, as `_w`."""
    frame = F.window(ts, length, slide) if slide else F.window(ts, length)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("_w", frame)


def aggregated(rows: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Aggregates per window and keys."""
    out = rows.groupBy("_w", *keys).agg(*aggs)
    return out.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        *[c for c in out.columns if c != "_w" and c not in keys],
    )


def store_rows(rows: DataFrame, path: str, ts: str, batch_id: int) -> None:
    """Appends a batch below the days of its rows; a batch that is repeated replaces its own folders."""
    placed = rows.withColumns({DAY: F.to_date(F.col(ts).cast("timestamp")), BATCH: F.lit(batch_id)})
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(path)


def rows_of_days(path: str, windows: DataFrame, until: int) -> DataFrame:
    """Stored rows of the days that some windows `_w` span, of batches up to one. Other days' folders are not looked into;
    the days are bounded by the calendar, so they are collected."""
    spark = windows.sparkSession
    last = F.to_date(F.col("_w.end") - F.expr("INTERVAL 1 MICROSECOND"))
    spanned = windows.select(F.explode(F.sequence(F.to_date("_w.start"), last)).alias("d")).distinct()
    days = {f"{DAY}={r.d}" for r in spanned.collect()} & set(folders(spark, path))
    stored = spark.read.option("basePath", path).parquet(*[f"{path}/{d}" for d in sorted(days)])
    return stored.where(F.col(BATCH) <= until)


def run_windows(
    stream: DataFrame, sink: str, checkpoint: str, ts: str, length: str, slide: str | None, keys: Sequence[str], aggs: Sequence[Column]
) -> None:
    """Keep windowed aggregates of a stream; a row counts however late it comes.

    Each micro-batch is stored by day and id, then the windows it touches are computed again from the stored rows of the
    days they span. Both writes replace themselves when a batch is repeated. Nothing is held in stream state.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        store_rows(batch, f"{sink}/rows", ts, batch_id)
        touched = in_windows(batch, ts, length, slide).select("_w", *keys).distinct()
        rows = in_windows(rows_of_days(f"{sink}/rows", touched, batch_id), ts, length, slide)
        again = rows.alias("r").join(touched.alias("k"), same_key("r", "k", ["_w", *keys]), "left_semi")
        write_batch(aggregated(again, keys, aggs), f"{sink}/windows", batch_id)

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def current_windows(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """Latest state of each window out of its updates."""
    return top_n_per_group(
        read_batches(spark, f"{sink}/windows"), ["window_start", *keys], [F.desc("_batch_id")]
    ).drop("_batch_id")
