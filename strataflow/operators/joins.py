"""Join helpers: presence tests, lookups and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

BROADCAST_LIMIT = 64 * 1024 * 1024
BROADCAST_ROWS = 200_000


def plan_bytes(df: DataFrame) -> int:
    """Size the optimizer expects for this plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only where the plan's own estimate is below the limit.

    Above it the frame is returned as is and the join shuffles (with runtime skew splitting).
    """
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def broadcast_groups(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast an aggregate whose number of groups is counted first.

    The optimizer cannot tell how far an aggregate shrinks its input, and joining the input
    back on a few heavy groups by shuffle would put each group in one task. The aggregate is
    written once, counted, and broadcast only below `max_rows`; above it there are many
    groups and the join shuffles, with runtime skew splitting.
    """
    written = stage(df)
    return F.broadcast(written) if written.count() <= max_rows else written


def exists_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on), list(on), "left_semi")


def missing_from(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of df without a partner (orphans, unmerged rows)."""
    return df.join(other.select(*on), list(on), "left_anti")


def left_aggregate(
    df: DataFrame, other: DataFrame, key: str, aggs: Sequence[Column], defaults: dict[str, object] | None = None
) -> DataFrame:
    """Left join to `other` aggregated by key; the aggregate runs before the join."""
    summary = other.groupBy(key).agg(*aggs)
    out = df.join(summary, key, "left")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def hot_limit(lookup: DataFrame, frequency: str, max_rows: int = BROADCAST_ROWS) -> int:
    """Frequency that about `max_rows` keys at most reach; 1 if there are no more keys."""
    n = lookup.count()
    if n <= max_rows:
        return 1
    return int(lookup.agg(F.percentile_approx(frequency, 1 - max_rows / n, 10_000)).first()[0]) + 1


def lookup_by_hot_key(
    facts: DataFrame, lookup: DataFrame, key: str, value: str, frequency: str, hot: int = 1_000_000
) -> DataFrame:
    """Inner lookup of one value by key, where the lookup itself says how frequent each key is (once at least).

    Keys seen at least `hot` times are at most (facts / hot) rows and are broadcast, so the facts they match stay where they
    are; the shuffle join only sees facts with keys below `hot`. Facts are read once for each of the two, or once if `hot`
    leaves no key below it.
    """
    frequent = lookup.where(F.col(frequency) >= hot).select(key, value)
    found = facts.join(F.broadcast(frequent), key)
    if hot > 1:
        rare = lookup.where(F.col(frequency) < hot).select(key, value)
        found = found.unionByName(facts.join(F.broadcast(frequent.select(key)), key, "left_anti").join(rare, key))
    return found.select(*facts.columns, value).where(F.col(value).isNotNull())
