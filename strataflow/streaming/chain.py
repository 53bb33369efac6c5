"""Event-driven chain: alerts and escalations from what is new, then a metrics snapshot."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.sinks import upsert
from .alerts import flagged_alerts, ticket_escalations
from .ingest import RunResult, consume


@dataclass(frozen=True)
class ChainResult:
    alerts: RunResult
    escalations: RunResult
    snapshot_version: int


def run_chain(
    spark: SparkSession,
    transactions: DataFrame,
    tickets: DataFrame,
    snapshot: Callable[[], DataFrame],
    root: str,
    **rules,
) -> ChainResult:
    """One trigger: both consumers at the same time, then the snapshot, whether or not they had data."""
    with ThreadPoolExecutor(2) as pool:
        alerts = pool.submit(
            consume, transactions, f"{root}/raw/alerts", f"{root}/_checkpoints/alerts", flagged_alerts
        )
        escalations = pool.submit(
            consume,
            tickets,
            f"{root}/raw/escalations",
            f"{root}/_checkpoints/escalations",
            lambda b: ticket_escalations(b, **rules),
        )
        done = alerts.result(), escalations.result()
    version = upsert(spark, f"{root}/consumption/metrics_snapshot", snapshot(), ["metric_date"])
    return ChainResult(*done, version)
