"""Helpers shared by the operators: text batches as byte arrays, word hashing, tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

U64 = np.uint64
#: An odd base for byte polynomials modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C13
UNBASE = pow(BASE, -1, 2**64)
#: Bytes of text that are worked on at once; one longer text is a chunk of its own.
CHUNK = 2 << 20
#: Rows and bytes in an Arrow batch at most: texts are long, and a batch is held whole on both sides of a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def small_batches(spark) -> None:
    for what, most in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.max{what}PerBatch"
        now = spark.conf.get(key)
        spark.conf.set(key, min(most, int(now)) if now.isdigit() and int(now) else most)


def select_texts(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator needs, under its own names, so other columns cannot clash."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *[F.col(c) for c in more])


def own_path(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


@contextmanager
def exchanges_go(spark):
    """The files of a write's own exchanges go when it ends, or they would lie beside those of the next steps."""
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder and read again: cuts lineage, survives lost executors."""
    path = own_path(df.sparkSession, name)
    with exchanges_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark, path: str) -> None:
    """Remove an operator's own table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and where each text begins (one more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about `limit` bytes of column `text`."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit, "right"))
            hi = max(lo + 1, hi)
            yield batch.slice(lo, hi - lo)
            lo = hi


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)


def word_class() -> np.ndarray:
    """Bytes of the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of lower-cased text."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def token_class() -> np.ndarray:
    """Bytes of the tokens `[^\\x20\\x09-\\x0D]+`."""
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    return table


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of true values that stays within one text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    begins = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return begins, ends


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Polynomial:
    """64-bit hashes of any byte ranges of a buffer, from one prefix sum."""

    _pow = np.ones(1, np.uint64)
    _inv = np.ones(1, np.uint64)

    def __init__(self, raw: np.ndarray, seed: int = 1):
        n = len(raw)
        cls = type(self)
        if len(cls._pow) < n + 1:
            cls._pow, cls._inv = powers(BASE, 2 * n + 1024), powers(UNBASE, 2 * n + 1024)
        codes = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[raw] * cls._pow[:n], out=self.sums[1:])

    def __call__(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        part = (self.sums[ends] - self.sums[begins]) * type(self)._inv[begins]
        return mix(part + (ends - begins).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def per_text(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text that each sorted or unsorted position belongs to."""
    return np.searchsorted(offsets, positions, "right") - 1


def covered(begins: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True where one of the ranges covers a place among `n`."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, begins, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0
