"""Pivot, unpivot, flatten and labelled counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot: str, values: Sequence[str], measure: Column) -> DataFrame:
    """One column per listed value; naming the values saves the job that would look them up.

    Rows whose value is not listed keep their group but feed no column.
    """
    sums = [F.sum(F.when(F.col(pivot) == v, measure)).alias(v) for v in values]
    return df.groupBy(*keys).agg(*sums)


def unpivot_values(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    """Long form of the measures; null measures give no row."""
    return df.unpivot(list(keys), list(measures), name, value).where(F.col(value).isNotNull())


def flatten(df: DataFrame, array: Column, index: str, value: str, outer: bool = False) -> DataFrame:
    """One row per array element with its zero-based index; outer keeps rows without elements."""
    fn = F.posexplode_outer if outer else F.posexplode
    return df.select("*", fn(array).alias(index, value))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def labelled_counts(tables: dict[str, DataFrame], label: str = "table_name", count: str = "row_count") -> DataFrame:
    """Row count of each table under its label, as one job."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias(count)).select(F.lit(name).alias(label), count) for name, df in tables.items()]
    )


def value_counts(df: DataFrame, *cols: str, count: str = "n") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(count))


def combine_single_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Put one-row aggregates side by side: all but the first come in as scalar subqueries, so nothing is joined."""
    first, rest = frames[0], frames[1:]
    packed = [f.select(F.struct(*f.columns)).scalar().alias(f"_s{i}") for i, f in enumerate(rest)]
    wide = first.select("*", *packed)
    fields = [F.col(f"_s{i}.{c}").alias(c) for i, f in enumerate(rest) for c in f.columns]
    return wide.select(*first.columns, *fields)
