"""Exact interpolated percentiles per group without collecting a group's values in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The written histogram (_key, _v, _c) of a column per group, nulls included: rows are read once, combined before the
    shuffle, and counts, sums, extremes and percentiles all come from it."""
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("all"))
    return stage(df.select(key.alias("_key"), F.col(value).alias("_v")).groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("_c")))


def group_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    percentiles: dict[str, float],
    width: float = 1000.0,
) -> DataFrame:
    """One row per group with the named percentiles of an exact (decimal or integer) column."""
    return percentiles_of(value_counts(df, keys, value), keys, percentiles, width)


def group_summary(
    df: DataFrame, keys: Sequence[str], value: str, percentiles: dict[str, float], width: float = 1000.0
) -> DataFrame:
    """Per group `n_rows`, `n_values`, `total` and `highest` of an exact column beside its percentiles, in one pass."""
    counts = value_counts(df, keys, value)
    base = counts.groupBy("_key").agg(
        F.sum("_c").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("n_values"),
        F.sum(F.col("_v") * F.col("_c")).alias("total"),
        F.max("_v").alias("highest"),
    )
    base = base.select(*[F.col(f"_key.{k}").alias(k) for k in keys], "n_rows", "n_values", "total", "highest")
    same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    found = percentiles_of(counts, keys, percentiles, width)
    return base.alias("a").join(found.alias("b"), same, "left").select("a.*", *[F.col(f"b.{n}") for n in percentiles])


def percentiles_of(counts: DataFrame, keys: Sequence[str], percentiles: dict[str, float], width: float = 1000.0) -> DataFrame:
    """Interpolated percentiles out of `value_counts`.

    1. count rows per (group, block of `width` values) and find the blocks that hold the wanted ranks;
    2. only inside those blocks, walk the values in order.

    A block holds at most width x 10^scale distinct values, whatever the group size.
    """
    hist = counts.where(F.col("_v").isNotNull()).withColumn("_block", F.floor(F.col("_v") / F.lit(width)).cast("long"))
    blocks = hist.groupBy("_key", "_block").agg(F.sum("_c").alias("_bc"))
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_bc").over(earlier), F.lit(0)))
    blocks = blocks.withColumn("_n", F.sum("_bc").over(Window.partitionBy("_key")))

    def ranks(p: float):
        spot = F.lit(float(p)) * (F.col("_n") - 1)
        return F.floor(spot), F.ceil(spot), spot - F.floor(spot)

    wanted = None
    for p in percentiles.values():
        for rank in ranks(p)[:2]:
            test = (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_bc"))
            wanted = test if wanted is None else wanted | test
    needed = blocks.where(wanted).select("_key", "_block", "_before", "_n")

    walk = Window.partitionBy("_key", "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    rows = hist.join(needed, ["_key", "_block"]).withColumn("_end", F.col("_before") + F.sum("_c").over(walk))
    rows = rows.withColumn("_start", F.col("_end") - F.col("_c"))
    picks = []
    for name, p in percentiles.items():
        low, high, part = ranks(p)
        for tag, rank in (("lo", low), ("hi", high)):
            hit = (rank >= F.col("_start")) & (rank < F.col("_end"))
            picks.append(F.max(F.when(hit, F.col("_v"))).cast("double").alias(f"_{tag}_{name}"))
        picks.append(F.max(part).alias(f"_f_{name}"))
    out = rows.groupBy("_key").agg(*picks)
    return out.select(
        *[F.col(f"_key.{k}").alias(k) for k in keys],
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in percentiles
        ],
    )
