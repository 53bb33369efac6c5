"""Shards of equal row counts that all hold the sources' mixture: proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the order of (rank + offset) / rows of the source
lays the sources through each other in proportion, and equal cuts of that order are the shards. Only DataFrame and SQL
functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

SHARDS = 40
SEED = 13
#: Bytes that a row takes besides its text.
OVERHEAD = 16
#: Steps of a source's offset within the distance of two of its rows.
STEPS = 1 << 20


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of a seeded digest as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _before(counts: DataFrame, by: str, *within: str) -> DataFrame:
    """How many rows the earlier blocks hold, `by` block number, inside `within`."""
    order = Window.partitionBy(*within).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0)))


def interleave(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", shards=SHARDS, seed=SEED) -> DataFrame:
    """The shard and place of every row. One row per input row: id, source, size (UTF-8 bytes of the text and 16),
    text_crc32 (unsigned), shard (0 to `shards` - 1), slot (place in the shard, gapless from 0).

    Row counts of shards differ by one at most, and each shard holds each source's share of rows but for about one.
    A null text has no bytes, like an empty one; rows without a source are one source; a null id takes part as an empty
    one. Repeated rows are counted, not compared: each copy has a place of its own, and copies follow each other in
    their source. Rows with the same id but different texts are ordered by size and checksum. With fewer rows than
    shards the rest of the shards is empty; an empty table gives no rows. Other columns are not read.

    Texts are read once and not shuffled. Every source is cut into blocks by hash, about sqrt(rows) over all, and the
    interleaved order into as many, so no source, however large, meets in one task; blocks are joined by prefix sums
    over their counts. Equal rows are counted before the first shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    )
    counted = shared_table(rows.groupBy("id", "source", "size", "crc").agg(F.count("*").alias("copies")), "shard-rows")
    total = max(1, counted.agg(F.sum("copies")).first()[0] or 0)
    blocks = math.isqrt(total - 1) + 1
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    keyed = counted.select(
        "*",
        name.alias("name"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))).alias("hash"),
    ).withColumn("block", F.shiftright(F.conv(F.substring("hash", 1, 8), 16, 10).cast("long") * blocks, 32))
    # Rank within the source: place in the block and the rows of the source's earlier blocks.
    tie = ["hash", F.asc_nulls_first("id"), "size", "crc"]
    here = Window.partitionBy("name", "block").orderBy(*tie).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("here", F.coalesce(F.sum("copies").over(here), F.lit(0)))
    earlier = _before(keyed.groupBy("name", "block").agg(F.sum("copies").alias("rows")), "block", "name")
    earlier = earlier.withColumn("all", F.sum("rows").over(Window.partitionBy("name"))).drop("rows")
    offset = _number(F.concat(F.lit(f"{seed}:"), F.col("name")), 5)
    ranked = (
        placed.join(earlier, ["name", "block"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("share", ((F.col("before") + F.col("here") + F.col("copy")) * STEPS + offset) / (F.col("all") * STEPS))
        .withColumn("cut", F.least(F.floor(F.col("share") * blocks), F.lit(blocks - 1)))
        .select("id", "source", "name", "size", "crc", "hash", "copy", "share", "cut")
    )
    ranked = shared_table(ranked, "shard-ranks")
    # Place in the interleaved order, by blocks of the share; sqrt(rows) counts at most are summed and broadcast.
    order = Window.partitionBy("cut").orderBy("share", "name", *tie, "copy")
    cuts = _before(ranked.groupBy("cut").agg(F.count("*").alias("rows")), "cut").drop("rows")
    at = (
        ranked.withColumn("here", F.row_number().over(order) - 1)
        .join(F.broadcast(cuts), "cut")
        .withColumn("at", F.col("before") + F.col("here"))
        .withColumn("shard", F.floor(F.expr(f"at * {shards} div {total}")).cast("int"))
    )
    first = F.expr(f"(CAST(shard AS BIGINT) * {total} + {shards - 1}) div {shards}")
    return at.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("at") - first).alias("slot"),
    )


def write_shards(df: DataFrame, path: str, id_col="doc_id", text_col="text", source_col="source", shards=SHARDS, seed=SEED, files=1) -> None:
    """All rows with all their columns below `path`, one folder `shard=<n>` for each shard, ordered by slot.

    A shard is cut into `files` ranges of slots. Rows of the same id, source, size and checksum take their places in
    any order. Columns named `shard` or `slot` are replaced.
    """
    key = ["__id", "__source", "__size", "__crc"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    count = Window.partitionBy(*key).orderBy(F.lit(1))
    source = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    own = df.drop("shard", "slot").select(
        "*", source(id_col).alias("__id"), source(source_col).alias("__source"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("__size"), F.crc32(text.cast("binary")).alias("__crc"),
    ).withColumn("__copy", F.row_number().over(count))
    places = interleave(df, id_col, text_col, source_col, shards, seed).select(
        source(id_col).alias("__id"), source(source_col).alias("__source"), F.col("size").alias("__size"), F.col("text_crc32").alias("__crc"), "shard", "slot",
    ).withColumn("__copy", F.row_number().over(count))
    out = own.join(places, [*key, "__copy"]).drop(*key, "__copy")
    out = out.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)


def shard_table(df: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The contract's columns: the law that holds is `rows`; groups of equal texts are not kept together."""
    placed = interleave(df, id_col, text_col, source_col)
    return placed.select(
        F.col(id_col).alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), source_col,
    )
