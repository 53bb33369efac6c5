"""Table sinks on plain parquet folders: versions, keyed merges and per-batch appends.

A table is a folder of `v=<n>` versions. A version counts once Spark's commit marker is in
it, so a write that dies half way is never read, and readers keep the version they opened.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.windows import top_n_per_group


def _folder(spark: SparkSession, path: str):
    """Hadoop's path and file system of a folder."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Moves a written folder into place in one step."""
    folder, fs = _folder(spark, path)
    to, _ = _folder(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(folder, to):
        raise FileExistsError(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def _committed(spark: SparkSession, path: str, prefix: str) -> dict[int, int]:
    """Number -> commit stamp (time of the commit marker) of the committed folders `<prefix><number>` below a path."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return {}
    out = {}
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if fs.exists(marker):
                out[int(name[len(prefix):])] = fs.getFileStatus(marker).getModificationTime()
    return dict(sorted(out.items()))


def current_version(spark: SparkSession, path: str) -> int:
    """Newest committed version, 0 for none."""
    return max(_committed(spark, path, "v="), default=0)


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    version = current_version(spark, path)
    if version:
        return spark.read.parquet(f"{path}/v={version}")
    if schema is None:
        raise FileNotFoundError(f"no committed version below {path}")
    return spark.createDataFrame([], schema)


def write_version(df: DataFrame, path: str) -> int:
    version = current_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={version}")
    return version


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition on keys of two aliased sides; null keys are equal."""
    both = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, both)


def without_keys(rows: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in `keyed`."""
    return rows.alias("r").join(keyed.select(*keys).alias("k"), same_key("r", "k", keys), "left_anti")


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the source rows put in place of rows of the same key (update all, else insert)."""
    kept = without_keys(target, source, keys)
    return kept.unionByName(source.select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Source rows whose key the target lacks, one per key."""
    fresh = without_keys(source, target, keys)
    if order:
        return top_n_per_group(fresh, keys, order)
    return fresh.dropDuplicates(list(keys))


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str]) -> int:
    """Merge by key into a new version. Source keys must be unique (see latest_per_key)."""
    if not current_version(spark, path):
        return write_version(source, path)
    return write_version(upsert_rows(read_current(spark, path), source, keys), path)


def insert_only(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> int:
    """Add rows with new keys, leave existing rows as they are."""
    if not current_version(spark, path):
        first = top_n_per_group(source, keys, order) if order else source.dropDuplicates(list(keys))
        return write_version(first, path)
    target = read_current(spark, path)
    return write_version(target.unionByName(new_rows(target, source, keys, order).select(*target.columns)), path)


def insert_if_empty(spark: SparkSession, path: str, source: DataFrame) -> bool:
    """Seed a table once."""
    if current_version(spark, path) and not read_current(spark, path).isEmpty():
        return False
    write_version(source, path)
    return True


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Net state of several changes: the last row per key."""
    return top_n_per_group(df, keys, order)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch under its own id; writing the same id again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")


def batch_stamps(spark: SparkSession, path: str) -> dict[int, int]:
    """Committed batches and their commit stamps: a batch that is written again under its id has a new one."""
    return _committed(spark, path, "_batch_id=")


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    return list(batch_stamps(spark, path))


def read_batches(spark: SparkSession, path: str, only: Iterable[int] | None = None) -> DataFrame:
    """All committed batches (or only those of some ids) with their `_batch_id`."""
    ids = batch_ids(spark, path) if only is None else sorted(only)
    if not ids:
        raise FileNotFoundError(f"no batch below {path}")
    return spark.read.option("basePath", path).parquet(*[f"{path}/_batch_id={i}" for i in ids])


def micro_batches(source: DataFrame, path: str, batch: Column, flagged: Column, amount: str) -> DataFrame:
    """Append the source as batches numbered by `batch`; returns per batch rows, total and flags.

    A batch that is written again replaces itself."""
    numbered = source.withColumn("_batch_id", batch).withColumn("_streamed_at", F.current_timestamp())
    writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_batch_id").parquet(path)
    return (
        source.sparkSession.read.parquet(path)
        .groupBy("_batch_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(amount).cast("double").alias("total"),
            F.count_if(flagged).alias("flagged"),
        )
    )
