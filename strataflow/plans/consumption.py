"""Consumption layer: business aggregates, segments and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from ..functions.compat import date_diff, dbl_avg, dbl_ratio, flag_count, percent, ratio_or_zero
from ..operators.cuts import tiles_by_cuts
from ..operators.distinct import Domain, count_distinct
from ..operators.joins import broadcast_groups
from ..operators.reshape import combine_single_rows
from ..operators.windows import range_totals, top_n_per_group
from ..session import stage


def transaction_metrics(enriched: DataFrame, as_of: Column, categories: Domain | None = None) -> DataFrame:
    """Per customer activity, spend, flags and variety."""
    rolled = count_distinct(
        enriched,
        ["customer_id"],
        "merchant_name",
        {"category": categories or Domain.of(enriched.select("category"))},
        {
            "total_transactions": (F.count(F.lit(1)), "sum"),
            "total_spent": (F.sum(F.when(F.col("txn_type") == "DEBIT", F.col("amount")).otherwise(0)), "sum"),
            "amount": (F.sum("amount"), "sum"),
            "amounts": (F.count("amount"), "sum"),
            "flagged_transactions": (flag_count(F.col("is_flagged")), "sum"),
            "last": (F.max("txn_date"), "max"),
        },
    )
    return rolled.select(
        "customer_id",
        "total_transactions",
        "total_spent",
        dbl_ratio("amount", "amounts").alias("avg_transaction"),
        "flagged_transactions",
        date_diff("day", F.col("last"), as_of).alias("days_since_last_txn"),
        F.col("n_merchant_name").alias("unique_merchants"),
        F.col("n_category").alias("unique_categories"),
    )


def customer_360(
    profile: DataFrame, enriched: DataFrame, tickets: DataFrame, as_of: Column, categories: Domain | None = None
) -> DataFrame:
    """Profile with transaction and ticket metrics and a segment."""
    activity = transaction_metrics(enriched, as_of, categories)
    support = tickets.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        flag_count(F.col("resolution_status").isin("OPEN", "IN_PROGRESS")).alias("open_tickets"),
        flag_count(F.col("priority").isin("HIGH", "CRITICAL")).alias("high_priority_tickets"),
    )
    kept = (
        "customer_id customer_name email city country annual_income employment_status credit_score signup_date "
        "total_accounts active_accounts total_balance total_credit_limit latest_risk_score "
        "latest_credit_history debt_to_income"
    ).split()
    out = profile.select(*kept).join(activity, "customer_id", "left").join(support, "customer_id", "left")
    defaults = {c: 0 for c in activity.columns + support.columns if c != "customer_id"}
    defaults["days_since_last_txn"] = scoring.NO_TRANSACTION_DAYS
    out = out.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)) for c, v in defaults.items()}
    )
    return out.withColumn("customer_segment", scoring.customer_segment("total_balance", "total_transactions"))


def daily_financial_metrics(enriched: DataFrame) -> DataFrame:
    """Nine measures per day."""
    flagged = flag_count(F.col("is_flagged"))
    return enriched.groupBy(F.to_date("txn_date").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("amount").alias("total_volume"),
        F.sum(F.when(F.col("txn_type") == "DEBIT", F.col("amount")).otherwise(0)).alias("total_debits"),
        F.sum(F.when(F.col("txn_type") == "CREDIT", F.col("amount")).otherwise(0)).alias("total_credits"),
        dbl_avg("amount").alias("avg_transaction"),
        F.max("amount").alias("max_transaction"),
        flagged.alias("flagged_count"),
        percent(flagged, F.count(F.lit(1))).alias("flagged_rate"),
    )


def risk_dashboard(profile: DataFrame) -> DataFrame:
    """Assessed customers with their tier."""
    return profile.where(F.col("latest_risk_score").isNotNull()).select(
        "customer_id",
        "customer_name",
        "city",
        "country",
        "credit_score",
        "total_balance",
        "latest_risk_score",
        "latest_credit_history",
        "debt_to_income",
        "total_accounts",
        scoring.dashboard_tier("latest_risk_score").alias("risk_tier"),
    )


def channel_performance(enriched: DataFrame, approx: bool = False, categories: Domain | None = None) -> DataFrame:
    """Per channel and day; `approx` trades the two exact distinct counts for sketches."""
    dated = enriched.withColumn("metric_date", F.to_date("txn_date"))
    keys = ["channel", "metric_date"]
    measures = {
        "transaction_count": (F.count(F.lit(1)), "sum"),
        "total_volume": (F.sum("amount"), "sum"),
        "amounts": (F.count("amount"), "sum"),
        "flagged_count": (flag_count(F.col("is_flagged")), "sum"),
    }
    if approx:
        rolled = dated.groupBy(*keys).agg(
            F.approx_count_distinct("customer_id").alias("n_customer_id"),
            F.approx_count_distinct("category").alias("n_category"),
            *[agg.alias(name) for name, (agg, _) in measures.items()],
        )
    else:
        sets = {"category": categories or Domain.of(enriched.select("category"))}
        rolled = count_distinct(dated, keys, "customer_id", sets, measures)
    return rolled.select(
        *keys,
        "transaction_count",
        "total_volume",
        dbl_ratio("total_volume", "amounts").alias("avg_amount"),
        F.col("n_customer_id").alias("unique_customers"),
        "flagged_count",
        F.col("n_category").alias("categories_used"),
    )


CHURN_FEATURES = (
    "annual_income credit_score tenure_days total_accounts active_accounts total_balance total_credit_limit "
    "credit_utilization total_transactions total_spent avg_transaction days_since_last_txn unique_merchants "
    "unique_categories flagged_transactions risk_score debt_to_income total_tickets open_tickets "
    "high_priority_tickets"
).split()
# The label is computed from these two; leave them out to train without leakage.
CHURN_LABEL_SOURCES = ("days_since_last_txn", "active_accounts")


def churn_features(c360: DataFrame, as_of: Column, exclude_label_sources: bool = False) -> DataFrame:
    """Twenty features and the churn label per customer."""
    out = c360.withColumns(
        {
            "tenure_days": date_diff("day", "signup_date", as_of),
            "credit_utilization": ratio_or_zero(F.col("total_balance"), F.col("total_credit_limit")),
            "risk_score": F.coalesce("latest_risk_score", F.lit(scoring.DEFAULT_RISK_SCORE)),
            "debt_to_income": F.coalesce("debt_to_income", F.lit(scoring.DEFAULT_DEBT_TO_INCOME)),
            "is_churned": scoring.churn_label("days_since_last_txn", "active_accounts"),
        }
    )
    for money in ("annual_income", "total_balance", "total_credit_limit", "total_spent"):
        out = out.withColumn(money, F.col(money).cast("double"))
    skip = CHURN_LABEL_SOURCES if exclude_label_sources else ()
    return out.select("customer_id", *[f for f in CHURN_FEATURES if f not in skip], "is_churned")


def monthly_revenue(daily: DataFrame) -> DataFrame:
    """Months from days. monthly_active_customers sums daily distinct counts, and the two
    averages are means of daily values, as the measure names are defined in this model."""
    return daily.groupBy(F.trunc("metric_date", "month").alias("revenue_month")).agg(
        F.sum("total_transactions").alias("monthly_transactions"),
        F.sum("unique_customers").alias("monthly_active_customers"),
        F.sum("total_volume").alias("monthly_volume"),
        F.sum("total_debits").alias("monthly_debits"),
        F.sum("total_credits").alias("monthly_credits"),
        F.avg("avg_transaction").alias("avg_daily_txn_amount"),
        F.max("max_transaction").alias("peak_transaction"),
        F.sum("flagged_count").alias("monthly_flags"),
        F.avg("flagged_rate").alias("avg_flag_rate"),
        F.countDistinct("metric_date").alias("trading_days"),
    )


def market_overview(latest: DataFrame) -> DataFrame:
    """Daily return and two signals per ticker."""
    change = (F.col("close_price") - F.col("open_price")) / F.nullif("open_price", F.lit(0.0)) * 100
    return latest.withColumns(
        {
            "daily_return_pct": F.round(change, 2),
            "rsi_signal": scoring.rsi_signal("rsi"),
            "macd_signal": scoring.macd_signal("macd"),
        }
    )


def compliance_summary(enriched_docs: DataFrame) -> DataFrame:
    """Documents by type, body, status, classification and cycle."""
    keys = ("doc_type", "regulatory_body", "doc_status", "classification", "review_cycle")
    return enriched_docs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("doc_count"),
        F.avg("content_length").alias("avg_content_length"),
        F.min("created_at").alias("earliest_doc"),
        F.max("created_at").alias("latest_doc"),
    )


def risk_factor_summary(factors: DataFrame) -> DataFrame:
    """Measures per factor and credit history."""
    return factors.groupBy("risk_factor", "credit_history").agg(
        F.count(F.lit(1)).alias("assessment_count"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.avg("debt_to_income").alias("avg_debt_to_income"),
        F.min("risk_score").alias("min_risk_score"),
        F.max("risk_score").alias("max_risk_score"),
        F.avg("factor_score").alias("avg_factor_score"),
    )


def metrics_snapshot(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, tickets: DataFrame, as_of: Column
) -> DataFrame:
    """One row of totals for a date; one aggregate per table."""
    balance = F.when(F.col("status") == "ACTIVE", F.col("balance"))
    row = combine_single_rows(
        [
            customers.agg(F.count(F.lit(1)).alias("total_customers")),
            accounts.agg(F.count(F.lit(1)).alias("total_accounts"), F.sum(balance).alias("aum")),
            transactions.agg(F.count(F.lit(1)).alias("total_transactions"), F.sum("amount").alias("total_volume")),
            tickets.agg(F.count(F.lit(1)).alias("total_tickets")),
        ]
    )
    return row.select(as_of.cast("date").alias("metric_date"), "*")


def rfm_segmentation(enriched: DataFrame, customers: DataFrame, as_of: Column) -> DataFrame:
    """Recency, frequency and monetary quintiles of debit spend, their sum and a segment.

    The quintiles are over all customers and cut at values found by selection; customer_id breaks ties. One narrow row
    per customer is written, as the selection reads it several times.
    """
    base = (
        enriched.where(F.col("txn_type") == "DEBIT")
        .groupBy("customer_id")
        .agg(
            date_diff("day", F.max("txn_date"), as_of).alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            F.sum("amount").alias("monetary"),
        )
    )
    who_id = F.col("customer_id")
    scores = {"r_score": (-F.col("recency_days"), who_id), "f_score": (F.col("frequency"), who_id), "m_score": (F.col("monetary"), who_id)}
    scored = tiles_by_cuts(stage(base), 5, scores)
    scored = scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
    who = customers.select("customer_id", "customer_name", "email", "city", "country")
    return scored.withColumn("segment", scoring.rfm_segment("rfm_score")).join(who, "customer_id")


def fraud_indicators(enriched: DataFrame, categories: Domain | None = None, channels: Domain | None = None) -> DataFrame:
    """Per customer flags, variety and spread; customers with at least one flag.

    The spread comes from exact sums of amounts and their squares, which merge."""
    sets = {"channel": channels or Domain.of(enriched.select("channel")), "category": categories or Domain.of(enriched.select("category"))}
    keys = ["customer_id", "customer_name"]
    rolled = count_distinct(
        enriched,
        keys,
        "merchant_name",
        sets,
        {
            "total_txns": (F.count(F.lit(1)), "sum"),
            "flagged_txns": (flag_count(F.col("is_flagged")), "sum"),
            "n": (F.count("amount"), "sum"),
            "s": (F.sum("amount"), "sum"),
            "squares": (F.sum(F.col("amount") * F.col("amount")), "sum"),
            "low": (F.min("amount"), "min"),
            "high": (F.max("amount"), "max"),
        },
    ).where(F.col("flagged_txns") > 0)
    n, s = F.col("n").cast("double"), F.col("s").cast("double")
    variance = (F.col("squares").cast("double") - s * s / n) / (n - 1)
    return rolled.select(
        *keys,
        "total_txns",
        "flagged_txns",
        percent(F.col("flagged_txns"), F.col("total_txns")).alias("flag_rate"),
        F.col("n_channel").alias("channels_used"),
        F.col("n_category").alias("categories_used"),
        F.col("n_merchant_name").alias("merchants_used"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("amount_stddev"),
        (F.col("high") - F.col("low")).alias("amount_range"),
    )


def transaction_velocity(
    rows: DataFrame, key: str, ts: str, amount: str, minimum: int = 5, seconds: int = 3600
) -> DataFrame:
    """Rows whose key had at least `minimum` rows in the last hour."""
    framed = range_totals(rows, [key], ts, seconds, {"txns_last_hour": F.lit(1), "amount_last_hour": F.col(amount)})
    return framed.where(F.col("txns_last_hour") >= minimum)


def account_hierarchy(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, tie: list[str], n_accounts: int = 2, n_txns: int = 3
) -> DataFrame:
    """Each customer's largest active accounts with their largest transactions.

    Accounts at the same balance share a rank, so more than `n_accounts` may qualify. Only
    transactions of qualifying accounts are ranked.
    """
    top_accounts = top_n_per_group(
        accounts.where(F.col("status") == "ACTIVE"),
        ["customer_id"],
        [F.desc_nulls_last("balance")],
        n_accounts,
        ties="rank",
        rank_col="account_rank",
    ).join(customers.select("customer_id", "customer_name", "city", "country"), "customer_id")
    wanted = transactions.join(top_accounts.select("account_id"), "account_id", "left_semi")
    top_txns = top_n_per_group(
        wanted, ["account_id"], [F.desc_nulls_last("amount"), *[F.asc(c) for c in tie]], n_txns, rank_col="txn_rank"
    )
    return top_accounts.join(top_txns, "account_id")


def with_category_statistics(transactions: DataFrame) -> DataFrame:
    """Each transaction with mean and deviation of its category's amounts."""
    amount = F.col("amount").cast("double")
    stats = transactions.groupBy("category").agg(
        dbl_avg("amount").alias("avg_amount"), F.stddev_samp(amount).alias("stddev_amount")
    )
    return transactions.join(broadcast_groups(stats), "category", "left")


def anomaly_scores(transactions: DataFrame) -> DataFrame:
    """Distance of each amount from its category mean, scaled to 0..100."""
    return with_category_statistics(transactions).withColumn(
        "anomaly_score", scoring.anomaly_score("amount", "avg_amount", "stddev_amount")
    )


def composite_risk(profile: DataFrame) -> DataFrame:
    """Tier from risk score, credit score and debt ratio."""
    return profile.select(
        "customer_id",
        "customer_name",
        "credit_score",
        "latest_risk_score",
        "debt_to_income",
        scoring.risk_tier("latest_risk_score", "credit_score", "debt_to_income").alias("risk_tier"),
    )


def high_balance_customers(profile: DataFrame, enriched: DataFrame, minimum: float = 100000) -> DataFrame:
    """Customers above a balance with their transaction count and debit spend."""
    rich = profile.where(F.col("total_balance") > minimum).select("customer_id", "customer_name", "total_balance")
    spend = enriched.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount")
    )
    return rich.join(spend, "customer_id", "left")
