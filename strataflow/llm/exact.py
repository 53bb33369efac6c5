"""Exact duplicates by content sort: sampled splitters, external sort, comparison of neighbours."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK, chunks, shared_table

#: Deleted before texts are compared.
BLANK = bytes([32, 9, 10, 11, 12, 13])
#: Bytes of the normalised text that lead the sort key; splitters are bounded by them.
LEAD = 48


def _keys(batches):
    for batch in chunks(batches):
        lead, digest, points = [], [], []
        for text in batch["text"].to_pylist():
            raw = text.encode().translate(None, BLANK)
            lead.append(raw[:LEAD])
            digest.append(hashlib.blake2b(raw, digest_size=8).digest())
            points.append(len(text))
        more = [pa.array(lead, pa.binary()), pa.array(digest, pa.binary()), pa.array(points, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lead", "digest", "points"])


def _neighbours(names, fields):
    """Walks a sorted partition. Equal texts share (lead, digest), so a stretch of equal keys holds its groups whole;
    the text itself decides. Only the stretch at hand is kept: ids of its rows, and one text for each group. With `carry`
    only the first row of each group is needed, so no other row is kept at all."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        schema = pa.schema(fields)
        out = {f.name: [] for f in fields}
        key, groups, rows = None, {}, []
        first_key, held = None, 0
        carries = "carry" in names

        def close(last):
            nonlocal held
            edge = last or key == first_key
            for row_id, g, carried, text in rows:
                lead_row = g["lead"]
                g["lead"] = False
                values = (row_id, g["sha"], g["keep"], g["points"], g["n"], lead_row, edge, part, carried, text)
                for name, v in zip(out, values, strict=False):
                    out[name].append(v)
                held += 100 + len(text or "")

        def flush():
            nonlocal held
            batch = pa.RecordBatch.from_pydict(out, schema=schema)
            for v in out.values():
                v.clear()
            held = 0
            return batch

        for batch in chunks(batches):
            ids, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            keys = zip(batch["lead"].to_pylist(), batch["digest"].to_pylist(), strict=True)
            points = batch["points"].to_pylist()
            carried = batch["carry"] if carries else None
            for i, k in enumerate(keys):
                if k != key:
                    if key is not None:
                        close(False)
                    if first_key is None:
                        first_key = k
                    key, groups, rows = k, {}, []
                    if held >= CHUNK:  # results leave by bytes, so long texts do not pile up
                        yield flush()
                norm = texts[i].encode().translate(None, BLANK)
                g = groups.get(norm)
                fresh = g is None
                if fresh:
                    g = groups[norm] = {"sha": hashlib.sha256(norm).hexdigest(), "keep": ids[i], "points": points[i], "n": 0, "lead": True}
                g["n"] += 1
                if carries and fresh:
                    rows.append((ids[i], g, carried[i].as_py(), texts[i]))
                elif not carries:
                    rows.append((ids[i], g, None, None))
        if key is not None:
            close(True)
        if out["id"]:
            yield flush()

    return run


def _marked(df: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """One row per document, with what its own sorted partition says about its group, and the merged edges."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cols = [F.col(id_col).alias("id"), text.alias("text")]
    if carry:
        rest = F.struct(*[F.col(c) for c in df.columns if c != text_col])
        cols.append(F.struct(F.col(text_col).isNull().alias("null"), rest.alias("row")).alias("carry"))
    src = df.select(*cols)
    spark = df.sparkSession
    keyed = src.mapInArrow(
        _keys,
        T.StructType([*src.schema.fields, T.StructField("lead", T.BinaryType()), T.StructField("digest", T.BinaryType()), T.StructField("points", T.LongType())]),
    )
    order = [F.asc("lead"), F.asc("digest"), F.desc("points"), F.asc_nulls_last("id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    id_type = src.schema["id"].dataType
    fields = [
        T.StructField("id", id_type),
        T.StructField("sha", T.StringType()),
        T.StructField("keep", id_type),
        T.StructField("points", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("lead", T.BooleanType()),
        T.StructField("edge", T.BooleanType()),
        T.StructField("part", T.IntegerType()),
    ]
    if carry:
        fields += [T.StructField("carry", src.schema["carry"].dataType), T.StructField("text", T.StringType())]
    schema = T.StructType(fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    marked = shared_table(ranged.mapInArrow(_neighbours(src.columns, list(to_arrow_schema(schema))), schema), "exact")
    edges = marked.filter("edge AND lead").select("sha", "points", "keep", "n", "part")
    merged = edges.groupBy("sha").agg(
        F.min(F.struct((-F.col("points")).alias("p"), F.col("keep").isNull().alias("x"), F.col("keep").alias("keep"), F.col("part").alias("part"))).alias("best"),
        F.sum("n").alias("total"),
    )
    # At most a few rows for each partition of the sort: the first and the last stretch of each.
    merged = merged.select("sha", F.col("best.keep").alias("best_keep"), F.col("best.part").alias("best_part"), "total")
    return marked.join(F.broadcast(merged), "sha", "left")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose texts are equal after deleting every character of `[\\x20\\x09-\\x0D]`.

    One row per input row: id, keep_id, group_size, kept, text_sha256 of the normalised text. The row with the most
    code points stays, then the smallest id. A null text counts as empty; empty texts are one group. A null id sorts
    after all others; of repeated rows with one id exactly one is kept. An empty table gives no rows. Columns of other
    names are not read.

    Texts are ordered by their first 48 normalised bytes, a digest, the length and the id; splitters are sampled over
    this whole key, so a group that holds a third of the rows is cut over many partitions. The sort is Spark's and
    spills. Equal texts lie side by side and are compared whole. Groups that cross a cut are joined by two summaries
    per partition.
    """
    m = _marked(df, id_col, text_col, False)
    return m.select(
        F.col("id").alias(id_col),
        F.when(F.col("total").isNull(), F.col("keep")).otherwise(F.col("best_keep")).alias("keep_id"),
        F.coalesce("total", "n").alias("group_size"),
        (F.col("lead") & (F.col("best_part").isNull() | (F.col("best_part") == F.col("part")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows `exact_groups` keeps, with all their columns; decided in the same sort, without a join."""
    m = _marked(df, id_col, text_col, True)
    kept = m.filter("lead AND (best_part IS NULL OR best_part = part)")
    text = F.when(~F.col("carry.null"), F.col("text")).alias(text_col)
    return kept.select(*[text if c == text_col else F.col("carry.row")[c].alias(c) for c in df.columns])
