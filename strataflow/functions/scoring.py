"""Tier, segment and signal mappings and the two scoring functions, all as native columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .compat import col

# Thresholds and labels that results must reproduce.
RISK_TIERS = ((80, "CRITICAL"), (60, "HIGH"), (40, "MEDIUM"), (20, "LOW"))
COMPOSITE_TIERS = ((70, "CRITICAL"), (50, "HIGH"), (30, "MEDIUM"), (15, "LOW"))
RFM_SEGMENTS = ((12, "Champions"), (9, "Loyal Customers"), (6, "Potential Loyalists"), (3, "At Risk"))
SEGMENT_RULES = ((200000, 50, "PLATINUM"), (100000, 25, "GOLD"), (25000, 10, "SILVER"))
SEGMENT_DEFAULT = "STANDARD"
CHURN_IDLE_DAYS = 90
NO_TRANSACTION_DAYS = 999
DEFAULT_RISK_SCORE = 50
DEFAULT_DEBT_TO_INCOME = 0.5
HIGH_VALUE_ALERT = 5000


def bucketize(c: str | Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the first band whose minimum the value reaches."""
    value = col(c)
    chain = None
    for minimum, label in bands:
        test = value >= F.lit(minimum)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(default))


def dashboard_tier(score: str | Column) -> Column:
    return bucketize(score, RISK_TIERS, "MINIMAL")


def rfm_segment(score: str | Column) -> Column:
    return bucketize(score, RFM_SEGMENTS, "Needs Attention")


def customer_segment(balance: str | Column, transactions: str | Column) -> Column:
    """Segment needs both a balance and an activity minimum."""
    chain = None
    for min_balance, min_count, label in SEGMENT_RULES:
        test = (col(balance) >= F.lit(min_balance)) & (col(transactions) >= F.lit(min_count))
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(SEGMENT_DEFAULT))


def rsi_signal(rsi: str | Column) -> Column:
    r = col(rsi)
    return F.when(r > 70, F.lit("OVERBOUGHT")).when(r < 30, F.lit("OVERSOLD")).otherwise(F.lit("NEUTRAL"))


def macd_signal(macd: str | Column) -> Column:
    return F.when(col(macd) > 0, F.lit("BULLISH")).otherwise(F.lit("BEARISH"))


def sentiment_label(score: str | Column, cut: float = 0.3) -> Column:
    s = col(score)
    return F.when(s < -cut, F.lit("NEGATIVE")).when(s > cut, F.lit("POSITIVE")).otherwise(F.lit("NEUTRAL"))


def alert_reason(amount: str | Column, merchant: str | Column, high_value: float = HIGH_VALUE_ALERT) -> Column:
    return (
        F.when(col(amount) > F.lit(high_value), F.lit("HIGH_VALUE_FLAGGED"))
        .when(col(merchant).ilike("%offshore%"), F.lit("SUSPICIOUS_MERCHANT"))
        .otherwise(F.lit("FLAGGED_TRANSACTION"))
    )


def churn_label(idle_days: str | Column, active_accounts: str | Column) -> Column:
    idle = col(idle_days) > F.lit(CHURN_IDLE_DAYS)
    return F.when(idle | (col(active_accounts) == 0), F.lit(1)).otherwise(F.lit(0))


def anomaly_score(amount: str | Column, mean: str | Column, stddev: str | Column) -> Column:
    """Distance from the mean in deviations, times 25, at most 100; 0 when it is undefined."""
    a, m, s = (col(x).cast("double") for x in (amount, mean, stddev))
    usable = a.isNotNull() & m.isNotNull() & s.isNotNull() & (s != 0)
    scaled = F.round(F.abs((a - m) / s) * 25, 2)
    return F.when(usable, F.least(scaled, F.lit(100.0))).otherwise(F.lit(0.0))


def risk_tier(risk: str | Column, credit: str | Column, debt_ratio: str | Column) -> Column:
    """Tier of half the risk score plus a credit part (up to 30) and a debt part (up to 20)."""
    risk_c = col(risk).cast("double")
    credit_part = F.coalesce((F.lit(850.0) - col(credit).cast("double")) / 850 * 30, F.lit(0.0))
    debt = col(debt_ratio).cast("double") * 20
    debt_part = F.when(debt.isNull(), F.lit(0.0)).otherwise(F.least(debt, F.lit(20.0)))
    composite = risk_c * 0.5 + credit_part + debt_part
    return F.when(risk_c.isNull(), F.lit("UNASSESSED")).otherwise(
        bucketize(composite, COMPOSITE_TIERS, "MINIMAL")
    )


def register_sql_functions(spark: SparkSession) -> None:
    """SQL surface of the two scoring functions: plain arithmetic, so SQL defines it and the optimizer inlines it."""
    tiers = " ".join(f"WHEN composite >= {minimum} THEN '{label}'" for minimum, label in COMPOSITE_TIERS)
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION anomaly_score(amount DOUBLE, mean DOUBLE, deviation DOUBLE) RETURNS DOUBLE RETURN
           CASE WHEN amount IS NOT NULL AND mean IS NOT NULL AND deviation IS NOT NULL AND deviation <> 0
                THEN least(round(abs((amount - mean) / deviation) * 25, 2), 100D) ELSE 0D END"""
    )
    composite = "risk * 0.5D + coalesce((850D - credit) / 850 * 30, 0D) + CASE WHEN debt_ratio IS NULL THEN 0D ELSE least(debt_ratio * 20, 20D) END"
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION risk_tier(risk DOUBLE, credit DOUBLE, debt_ratio DOUBLE) RETURNS STRING RETURN
            CASE WHEN risk IS NULL THEN 'UNASSESSED' {tiers.replace("composite", f"({composite})")} ELSE 'MINIMAL' END"""
    )
