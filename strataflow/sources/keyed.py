"""Tables merged by key: rows lie in hash buckets, a merge rewrites the buckets its source touches, and every merge leaves
the rows it changed as a feed that streams can read (S14, S15, K10)."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import snapshot_diff
from ..session import stage
from .sinks import batch_ids, current_version, folders, move_folder, new_rows, upsert_rows, without_keys, write_version

BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """A table in `buckets` hash buckets of its keys; null keys are a key like others.

    Bucket files are never changed: version n of the table is a list of (bucket, the version that wrote it). A version
    counts once its list is committed, so a merge that dies is not seen, and readers keep what they opened. `files` is
    how many files a bucket is cut into; choose buckets and files by the table's size when it is created.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int = 64
    files: int = 1

    @property
    def version(self) -> int:
        return current_version(self.spark, f"{self.path}/versions")

    def written_by(self, version: int | None = None) -> dict[int, int]:
        """Bucket -> the version that wrote its files; at most `buckets` entries."""
        version = self.version if version is None else version
        if not version:
            return {}
        listed = self.spark.read.schema("bucket int, written_by int").parquet(f"{self.path}/versions/v={version}")
        return {r.bucket: r.written_by for r in listed.collect()}

    def _rows(self, listed: dict[int, int]) -> DataFrame:
        if not listed:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/v={v}/{BUCKET}={b}" for b, v in sorted(listed.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.written_by(version))

    def upsert(self, source: DataFrame) -> int:
        """Source rows replace rows of their key or are added. Source keys must be unique (see latest_per_key)."""
        return self._merge(self._typed(source), lambda old, new: upsert_rows(old, new, self.keys))

    def insert_only(self, source: DataFrame, order: Sequence[Column] = ()) -> int:
        """Adds source rows whose key is new, of several the first by `order`; other rows stay as they are."""
        return self._merge(self._typed(source), lambda old, new: old.unionByName(new_rows(old, new, self.keys, order)))

    def delete(self, source: DataFrame) -> int:
        """Removes rows whose key is in the source."""
        return self._merge(source.select(*self.keys), lambda old, new: without_keys(old, new, self.keys))

    def _typed(self, source: DataFrame) -> DataFrame:
        """The table's columns in its types; others are left out."""
        return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _merge(self, source: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        self.publish()
        hashed = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows = stage(source.withColumn(BUCKET, hashed))
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
        version, listed = self.version, self.written_by()
        if not touched and version:
            return version
        old = self._rows({b: v for b, v in listed.items() if b in set(touched)})
        result = combine(old, rows.drop(BUCKET)).withColumn(BUCKET, hashed)
        part = F.pmod(F.xxhash64(*self.keys, F.lit("file")), F.lit(self.files))
        target = f"{self.path}/data/v={version + 1}"
        result.repartition(F.col(BUCKET), part).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        written = {int(f.removeprefix(f"{BUCKET}=")) for f in folders(self.spark, target) if f.startswith(BUCKET)}
        listed = {b: v for b, v in listed.items() if b not in touched} | dict.fromkeys(written, version + 1)
        manifest = self.spark.createDataFrame(sorted(listed.items()), "bucket int, written_by int").coalesce(1)
        write_version(manifest, f"{self.path}/versions")
        self.publish()
        return version + 1

    # The feed

    @property
    def feed(self) -> str:
        """Folder of the change files, one folder for each version; a stream's input."""
        return f"{self.path}/changes"

    @property
    def feed_schema(self) -> T.StructType:
        extra = [("_action", T.StringType()), ("_is_update", T.BooleanType()), ("_version", T.IntegerType())]
        return T.StructType(self.schema.fields + [T.StructField(n, k) for n, k in extra])

    def publish(self) -> None:
        """Writes the change files of committed versions that lack them: the old rows (DELETE) and new rows (INSERT) of
        the buckets that the version rewrote.

        They follow from two committed versions alone, so a merge that died after its commit is made up for by the next
        call. The folder is moved into place when it is whole, so a stream never takes half of it or takes it twice.
        """
        done = max(batch_ids(self.spark, self.feed), default=0)
        for version in range(done + 1, self.version + 1):
            before, after = self.written_by(version - 1), self.written_by(version)
            old = self._rows({b: v for b, v in before.items() if after.get(b) != v})
            new = self._rows({b: v for b, v in after.items() if before.get(b) != v})
            changes = snapshot_diff(old, new, self.keys).withColumn("_version", F.lit(version))
            draft = f"{self.path}/drafts/{uuid.uuid4().hex}"
            changes.write.parquet(draft)
            move_folder(self.spark, draft, f"{self.feed}/_batch_id={version}")

    def changes(self, after: int = 0) -> DataFrame:
        """Changed rows of all versions after one."""
        self.publish()
        ids = [i for i in batch_ids(self.spark, self.feed) if i > after]
        if not ids:
            return self.spark.createDataFrame([], self.feed_schema)
        return self.spark.read.schema(self.feed_schema).parquet(*[f"{self.feed}/_batch_id={i}" for i in ids])
