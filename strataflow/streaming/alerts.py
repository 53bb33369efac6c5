"""Alert and escalation rules, for batches and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import HIGH_VALUE_ALERT, alert_reason


def flagged_alerts(transactions: DataFrame, high_value: float = HIGH_VALUE_ALERT) -> DataFrame:
    """Alert rows for flagged transactions; the amount rule is tested before the merchant rule."""
    return transactions.where(F.col("is_flagged")).withColumns(
        {
            "alert_reason": alert_reason("amount", "merchant_name", high_value),
            "detected_at": F.current_timestamp(),
            "reviewed": F.lit(False),
        }
    )


def ticket_escalations(
    changes: DataFrame, priorities: Sequence[str] = ("HIGH", "URGENT"), statuses: Sequence[str] | None = None
) -> DataFrame:
    """Escalation rows for inserted tickets (an update counts as its new row) of some priorities."""
    wanted: Column = F.col("priority").isin(*priorities)
    if "_action" in changes.columns:
        wanted = wanted & (F.col("_action") == "INSERT")
    if statuses:
        wanted = wanted & F.col("resolution_status").isin(*statuses)
    return changes.where(wanted).withColumns(
        {
            "escalation_reason": F.concat(F.col("priority"), F.lit("_PRIORITY")),
            "escalated_at": F.current_timestamp(),
        }
    )
