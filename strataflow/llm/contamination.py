"""Benchmark decontamination: Wu-Manber search for windows of benchmark words."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Polynomial, chunks, lower_ascii, mix, runs, select_texts, text_bytes, word_class

WINDOW = 10
#: Windows in one broadcast block of patterns (about 130 bytes each); more windows make more blocks.
BLOCK_WINDOWS = 100_000
#: Bits of the shift table's index.
SHIFT_BITS = 18
#: Words that one lane of the search walks through before the next lane takes over.
LANE = 256


def words_of(column: pa.Array):
    """Lower-cased bytes, begin and end of every word, hash of every word, first word of every text."""
    raw, offsets = text_bytes(column)
    raw = lower_ascii(raw)
    begins, ends = runs(word_class()[raw], offsets)
    return raw, begins, ends, Polynomial(raw)(begins, ends), np.searchsorted(begins, offsets)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(3) + b)


class Patterns:
    """Windows of one length with their shift table and suffix buckets. A character is a word's hash, a block is two
    words (one, for windows of one word)."""

    def __init__(self, windows: list[tuple[bytes, ...]], owners: list[list[int]]):
        self.words, self.owners = windows, owners
        self.m = m = len(windows[0])
        self.block = min(2, m)
        raw = np.frombuffer(b"".join(w for p in windows for w in p), np.uint8)
        ends = np.cumsum([len(w) for p in windows for w in p])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        h = Polynomial(raw)(begins, ends).reshape(-1, m)
        blocks = self.blocks(h)
        width = blocks.shape[1]
        self.shift = np.full(1 << SHIFT_BITS, width, np.uint8 if width < 256 else np.int32)
        for j in range(width):  # later blocks are nearer to the window's end and have smaller shifts
            np.minimum.at(self.shift, (blocks[:, j] & U64((1 << SHIFT_BITS) - 1)).astype(np.int64), width - 1 - j)
        # A bucket: the hash of the last block, told apart by the first block.
        self.bucket = _pair(blocks[:, -1], blocks[:, 0])
        self.order = np.argsort(self.bucket, kind="stable")
        self.bucket = self.bucket[self.order]

    def blocks(self, h: np.ndarray) -> np.ndarray:
        return _pair(h[..., :-1], h[..., 1:]) if self.block == 2 else mix(h)

    def search(self, raw, begins, ends, hashes, first):
        """(first word of an occurrence, window) pairs over all texts of a chunk."""
        m, span = self.m, self.m - self.block
        lo, hi = first[:-1], first[1:] - m  # last place where a window can begin
        ok = hi >= lo
        lo, hi = lo[ok], hi[ok]
        if not len(lo):
            return []
        lanes = (hi - lo) // LANE + 1
        which = np.repeat(np.arange(len(lo)), lanes)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = lo[which] + nth * LANE
        stop = np.minimum(at + LANE - 1, hi[which])
        table, mask = self.shift, U64((1 << SHIFT_BITS) - 1)
        found = []
        while len(at):
            tail = at + span
            block = _pair(hashes[tail], hashes[tail + 1]) if self.block == 2 else mix(hashes[tail])
            step = table[(block & mask).astype(np.int64)].astype(np.int64)
            hit = step == 0
            if hit.any():
                p = at[hit]
                head = _pair(hashes[p], hashes[p + 1]) if self.block == 2 else mix(hashes[p])
                key = _pair(block[hit], head)
                b = np.searchsorted(self.bucket, key, "left")
                e = np.searchsorted(self.bucket, key, "right")
                for q, x, y in zip(p[e > b], b[e > b], e[e > b], strict=True):
                    text = tuple(raw[begins[i] : ends[i]].tobytes() for i in range(q, q + m))
                    found += [(int(q), int(j)) for j in self.order[x:y] if self.words[j] == text]
            at = at + np.maximum(step, 1)
            live = at <= stop
            at, stop = at[live], stop[live]
        return found


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows of the benchmark with the ids of their items."""

    def cut(batches):
        for batch in chunks(batches):
            raw, begins, ends, _, first = words_of(batch["text"])
            ids, out_ids, out = batch["id"].to_pylist(), [], []
            for k, item in enumerate(ids):
                w = [raw[begins[i] : ends[i]].tobytes() for i in range(first[k], first[k + 1])]
                for i in range(max(1, len(w) - WINDOW + 1) if w else 0):
                    out_ids.append(item)
                    out.append(b" ".join(w[i : i + WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, pa.string()), pa.array(out, pa.binary())], names=["item", "window"])

    src = select_texts(benchmark, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    return src.mapInArrow(cut, "item string, window binary").groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _blocks(windows: DataFrame):
    """Lists of patterns, each of bounded size, one after the other."""
    rows = []
    for r in windows.toLocalIterator():
        rows.append((bytes(r["window"]), list(r["items"])))
        if len(rows) == BLOCK_WINDOWS:
            yield rows
            rows = []
    if rows:
        yield rows


def _searcher(shared):
    def run(batches):
        groups = {}
        for window, items in shared.value:
            w = tuple(window.split(b" "))
            g = groups.setdefault(len(w), ([], []))
            g[0].append(w)
            g[1].append(items)
        patterns = [Patterns(*groups[m]) for m in sorted(groups)]
        for batch in chunks(batches):
            raw, begins, ends, hashes, first = words_of(batch["text"])
            marks, found = [], {}
            for p in patterns:
                for q, j in p.search(raw, begins, ends, hashes, first):
                    marks.append((q, q + p.m))
                    k = int(np.searchsorted(first, q, "right")) - 1
                    found.setdefault(k, set()).update(p.owners[j])
            spans, items = batch["spans"].to_pylist(), batch["items"].to_pylist()
            by = {}
            for q, e in marks:
                by.setdefault(int(np.searchsorted(first, q, "right")) - 1, []).append((int(q - first[:-1][int(np.searchsorted(first, q, "right")) - 1]), int(e - q)))
            for k, got in by.items():
                merged = []
                for s, e in sorted([(x["begin"], x["end"]) for x in spans[k]] + [(s, s + n) for s, n in got]):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                spans[k] = [{"begin": s, "end": e} for s, e in merged]
                items[k] = sorted(set(items[k]) | found[k])
            cols = {
                "n_words": pa.array(np.diff(first), pa.int64()),
                "spans": pa.array(spans, batch.schema.field("spans").type),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([cols.get(n, batch[n]) for n in batch.schema.names], names=batch.schema.names)

    return run


def contamination(df: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", carry=()) -> DataFrame:
    """Words of documents inside occurrences of benchmark windows, and the items these come from.

    A-Z is lower-cased; words are runs of digits, a-z and bytes from 128. A window is ten consecutive words of an item;
    an item of one to nine words is one window. One row per input row: id, text, carry columns, n_words, spans (word
    ranges, merged), items (ids as strings, sorted). A null text has no words, a text shorter than a window has no hit,
    an empty benchmark hits nothing. Windows of items with a null id mark words, but such items are not listed. Items
    that repeat or share an id count once. Columns of other names are not read.

    Texts are never shuffled: each block of at most BLOCK_WINDOWS windows is broadcast, and the table passes through
    one search per block.
    """
    spark = df.sparkSession
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    out = select_texts(df, id_col, text_col, *carry).select(
        "*", F.lit(0).cast("long").alias("n_words"), F.array().cast(span).alias("spans"), F.array().cast("array<string>").alias("items")
    )
    schema, any_block = out.schema, False
    for block in _blocks(benchmark_windows(benchmark, item_col, item_text)):
        any_block = True
        out = out.mapInArrow(_searcher(spark.sparkContext.broadcast(block)), schema)
    if not any_block:
        out = out.mapInArrow(_searcher(spark.sparkContext.broadcast([])), schema)
    return out


def contamination_report(df: DataFrame, benchmark: DataFrame, id_col="doc_id") -> DataFrame:
    """Counts and the digest of item ids, one row per document."""
    c = contamination(df, benchmark, id_col)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["begin"])
    return c.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        "spans",
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Rows without any benchmark window, with their own columns."""
    whole = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    return contamination(whole, benchmark, "doc", "body", carry=("row",)).filter(F.size("spans") == 0).select("row.*")


