"""Repeatable pseudo-random columns: a hash of (row key, salt), independent of partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .compat import col

_BITS = 1 << 31


def unit_uniform(key: str | Column, salt: str, seed: int = 42) -> Column:
    """Uniform double in [0, 1)."""
    return F.pmod(F.xxhash64(col(key), F.lit(salt), F.lit(seed)), F.lit(_BITS)) / F.lit(float(_BITS))


def uniform_int(key: str | Column, salt: str, low: int | Column, high: int | Column, seed: int = 42) -> Column:
    """Uniform integer in [low, high], both ends included."""
    low = F.lit(low) if isinstance(low, int) else low
    high = F.lit(high) if isinstance(high, int) else high
    return (low + F.floor(unit_uniform(key, salt, seed) * (high - low + 1))).cast("long")


def pick(key: str | Column, salt: str, values: Sequence[str], seed: int = 42) -> Column:
    """One of the values, equally likely; repeat a value to weight it."""
    index = uniform_int(key, salt, 0, len(values) - 1, seed).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def pick_weighted(key: str | Column, salt: str, choices: Sequence[tuple[str, float]], seed: int = 42) -> Column:
    """One of the values with the given weights (cumulative chain over one uniform draw)."""
    total = float(sum(w for _, w in choices))
    u = unit_uniform(key, salt, seed)
    chain, acc = None, 0.0
    for value, weight in choices[:-1]:
        acc += weight / total
        chain = F.when(u < acc, F.lit(value)) if chain is None else chain.when(u < acc, F.lit(value))
    last = F.lit(choices[-1][0])
    return last if chain is None else chain.otherwise(last)


def triangular(key: str | Column, salt: str, low: Column, high: Column, mode: Column, seed: int = 42) -> Column:
    """Triangular draw by inverting its distribution function."""
    u = unit_uniform(key, salt, seed)
    cut = (mode - low) / (high - low)
    left = low + F.sqrt(u * (high - low) * (mode - low))
    right = high - F.sqrt((F.lit(1.0) - u) * (high - low) * (high - mode))
    return F.when(u < cut, left).otherwise(right)


def sample_without_replacement(
    key: str | Column, salt: str, values: Sequence[str], n: int, seed: int = 42
) -> Column:
    """n distinct values: order the list by a per-row hash, keep the first n."""
    arr = F.array(*[F.lit(v) for v in values])
    keyed = F.transform(
        arr, lambda v: F.struct(F.xxhash64(col(key), v, F.lit(salt), F.lit(seed)).alias("h"), v.alias("v"))
    )
    return F.transform(F.slice(F.sort_array(keyed), 1, n), lambda s: s["v"])
