"""Data-quality checks, row-count reports and log summaries (Q)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.compat import flag_count
from .joins import missing_from
from .reshape import labelled_counts, union_all


@dataclass(frozen=True)
class Check:
    """A named count of violations on one column of one table."""

    metric: str
    table: str
    column: str
    violation: Callable[[Column], Column]


def null_check(table: str, column: str) -> Check:
    return Check(f"null_{column}", table, column, lambda c: c.isNull())


def range_check(table: str, column: str, low: float, high: float) -> Check:
    return Check(f"{column}_range", table, column, lambda c: (c < low) | (c > high))


def format_check(table: str, column: str, pattern: str) -> Check:
    """Non-null values that do not match a LIKE pattern."""
    return Check(f"{column}_format", table, column, lambda c: c.isNotNull() & ~c.like(pattern))


def negative_check(table: str, column: str) -> Check:
    return Check(f"negative_{column}", table, column, lambda c: c < 0)


def future_check(table: str, column: str, as_of: Column) -> Check:
    return Check(f"future_{column}", table, column, lambda c: c > as_of)


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check], measured_at: Column) -> DataFrame:
    """Long table of (time, table, column, metric, issue count); one scan per table."""
    parts = []
    for name, df in tables.items():
        mine = [c for c in checks if c.table == name]
        if not mine:
            continue
        counts = df.agg(
            *[F.count_if(c.violation(F.col(c.column))).alias(f"c{i}") for i, c in enumerate(mine)]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.table).alias("table_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.metric).alias("metric_name"),
                    F.col(f"c{i}").alias("issue_count"),
                )
                for i, c in enumerate(mine)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    return union_all(parts).select(measured_at.alias("measurement_time"), "*")


def latest_results(results: DataFrame, n: int = 20) -> DataFrame:
    """Newest measurements first."""
    return results.orderBy(F.desc("measurement_time"), "table_name", "column_name", "metric_name").limit(n)


def orphan_count(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    return missing_from(child, parent, on).agg(F.count(F.lit(1)).alias("orphans"))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null key part, and keys that occur more than once."""
    null_key = None
    for k in keys:
        null_key = F.col(k).isNull() if null_key is None else null_key | F.col(k).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(null_key).alias("_null"))
    return counts.agg(
        F.sum("_null").alias("null_keys"),
        F.count_if((F.col("_n") > 1) & (F.col("_null") == 0)).alias("duplicate_keys"),
    )


def layer_summary(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count per table; a table that does not exist counts as -1."""
    present = labelled_counts({n: d for n, d in tables.items() if d is not None})
    missing = [(n, -1) for n, d in tables.items() if d is None]
    if not missing:
        return present
    return present.unionByName(spark.createDataFrame(missing, "table_name string, row_count bigint"))


def usage_summary(log: DataFrame, role: str, user: str, failed: Column) -> DataFrame:
    """Volume, distinct users and failures per role."""
    return log.groupBy(role).agg(
        F.count(F.lit(1)).alias("query_count"),
        F.countDistinct(user).alias("unique_users"),
        flag_count(failed).alias("failed_queries"),
    )


def failed_attempts(log: DataFrame, failed: Column, ts: str, as_of: Column, days: int, keys: Sequence[str]) -> DataFrame:
    """Failures in the last days, per key."""
    recent = (F.col(ts) >= as_of - F.expr(f"INTERVAL {int(days)} DAY")) & (F.col(ts) < as_of)
    return (
        log.where(failed & recent)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("attempts"), F.max(ts).alias("last_attempt"))
    )


def accessed_any(log: DataFrame, objects: str, name_field: str, wanted: Sequence[str]) -> DataFrame:
    """Log rows whose nested list of objects names one of the wanted objects."""
    names = F.transform(F.col(objects), lambda o: o[name_field])
    return log.where(F.arrays_overlap(names, F.array(*[F.lit(w) for w in wanted])))


def performance_summary(runs: DataFrame, key: str) -> DataFrame:
    """Per name: runs, seconds, rows and the share of input that was read and reused."""
    return runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.avg("seconds"), 4).alias("avg_seconds"),
        F.sum("rows_out").alias("rows_out"),
        F.round(F.sum("parts_read") * 100.0 / F.nullif(F.sum("parts_total"), F.lit(0)), 2).alias("read_pct"),
        F.round(F.sum("parts_cached") * 100.0 / F.nullif(F.sum("parts_read"), F.lit(0)), 2).alias("cached_pct"),
    )


def file_listing(df: DataFrame) -> DataFrame:
    """Files behind a scan with their size and rows."""
    m = "_metadata"
    return (
        df.select(F.col(f"{m}.file_name").alias("file_name"), F.col(f"{m}.file_size").alias("file_size"))
        .groupBy("file_name", "file_size")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
