"""Dashboard data sets over the consumption tables (D)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.compat import dbl_avg, dbl_sum
from ..operators.reshape import combine_single_rows


def kpi_row(daily: DataFrame, c360: DataFrame) -> DataFrame:
    return combine_single_rows(
        [
            daily.agg(dbl_sum("total_volume").alias("total_volume"), F.sum("total_transactions").alias("transactions")),
            c360.agg(F.count(F.lit(1)).alias("customers"), dbl_sum("total_balance").alias("assets")),
        ]
    )


def churn_overview(churn: DataFrame) -> DataFrame:
    return churn.groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(F.avg("total_balance"), 4).alias("avg_balance"),
        F.round(F.avg("total_transactions"), 6).alias("avg_transactions"),
        F.round(F.avg("days_since_last_txn"), 6).alias("avg_idle_days"),
    )


def top_customers(c360: DataFrame, n: int = 20) -> DataFrame:
    return c360.orderBy(F.desc_nulls_last("total_balance"), "customer_id").limit(n)


def top_countries(c360: DataFrame, n: int = 15) -> DataFrame:
    return (
        c360.groupBy("country").agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "country").limit(n)
    )


def channel_totals(channel_daily: DataFrame) -> DataFrame:
    return channel_daily.groupBy("channel").agg(
        F.sum("transaction_count").alias("transactions"),
        dbl_sum("total_volume").alias("volume"),
        F.sum("flagged_count").alias("flagged"),
    )


def grouped_volume(transactions: DataFrame, *keys: str) -> DataFrame:
    """Count, volume and mean amount by any keys."""
    return transactions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("txn_count"),
        dbl_sum("amount").alias("total_volume"),
        dbl_avg("amount").alias("avg_amount"),
    )


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country").agg(
        F.count(F.lit(1)).alias("customers"),
        dbl_avg("annual_income").alias("avg_income"),
        dbl_avg("credit_score").alias("avg_credit"),
    )
