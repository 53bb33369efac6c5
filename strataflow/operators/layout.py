"""Physical layout as user operations: clustered copies, their quality, lookups, reuse (C)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .joins import plan_bytes


def clustered_copy(df: DataFrame, path: str, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Copy sorted by the keys across files.

    A hash of the row follows the keys in the range order, so a key with very many rows is
    cut over several files instead of filling one.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    order = [*[F.col(k) for k in keys], spread]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def file_ranges(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest and highest key per file."""
    key = F.struct(*[F.col(k) for k in keys])
    return (
        df.select(F.col("_metadata.file_path").alias("file"), key.alias("_k"))
        .groupBy("file")
        .agg(F.min("_k").alias("low"), F.max("_k").alias("high"), F.count(F.lit(1)).alias("n_rows"))
    )


def clustering_quality(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files, mean number of other files whose key range overlaps, and greatest depth.

    A sweep over range starts and ends. The input has one row per file, so the unpartitioned
    windows are bounded by the number of files.
    """
    r = file_ranges(df, keys)
    starts = r.select("file", F.col("low").alias("at"), F.lit(0).alias("kind"))
    ends = r.select("file", F.col("high").alias("at"), F.lit(1).alias("kind"))
    # At equal keys starts come first: touching ranges overlap.
    w = Window.partitionBy(F.lit(0)).orderBy("at", "kind", "file").rowsBetween(Window.unboundedPreceding, 0)
    started = F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(w)
    ended = F.sum(F.when(F.col("kind") == 1, 1).otherwise(0)).over(w)
    sweep = starts.unionByName(ends).withColumn("started", started).withColumn("ended", ended)
    depth = sweep.agg(F.max(F.col("started") - F.col("ended")).alias("max_depth"))
    # Files that started before this one ended, less those that ended before it started.
    own_end = sweep.where("kind = 1").select("file", F.col("started").alias("_s"))
    own_start = sweep.where("kind = 0").select("file", F.col("ended").alias("_e"))
    overlaps = own_end.join(own_start, "file").select((F.col("_s") - F.col("_e") - 1).alias("n"))
    from .reshape import combine_single_rows

    return combine_single_rows(
        [overlaps.agg(F.count(F.lit(1)).alias("n_files"), F.avg("n").alias("avg_overlaps")), depth]
    )


def lookup_copy(df: DataFrame, path: str, key: str, files: int | None = None) -> DataFrame:
    """Copy sorted by id with a bloom filter on it: point lookups skip files and row groups."""
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (
        ranged.sortWithinPartitions(key)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def files_for(df: DataFrame, least: int = 1, target: int = 128 << 20) -> int:
    """Output files of about `target` bytes each, by the size the optimizer expects."""
    return max(least, -(-plan_bytes(df) // target))


def reuse(df: DataFrame) -> DataFrame:
    """Keep a result for several readers: written once to the shared folder, so no executor has to hold it."""
    return stage(df)
