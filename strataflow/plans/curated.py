"""Curated layer: typed, joined and flattened forms of the base tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compat import date_diff
from ..operators.windows import top_n_per_group

RISK_SCHEMA = (
    "risk_score int, credit_history string, debt_to_income double, "
    "risk_factors array<struct<factor: string, score: int>>, assessment_type string, model_version string"
)
MARKET_SCHEMA = (
    "open double, high double, low double, close double, volume bigint, "
    "indicators struct<rsi: double, macd: double, moving_avg_50: double>"
)
METADATA_SCHEMA = (
    "regulatory_body string, status string, version string, effective_date string, "
    "review_cycle string, classification string"
)


def parsed(df: DataFrame, text: str, schema: str, renames: dict[str, str]) -> DataFrame:
    """Fields of one JSON text column, parsed once, under new names; malformed text gives nulls."""
    doc = F.from_json(F.col(text), schema)
    rest = [F.col(c) for c in df.columns if c != text]
    return df.withColumn("_doc", doc).select(*rest, *[F.col(f"_doc.{p}").alias(n) for p, n in renames.items()])


def risk_parsed(assessments: DataFrame) -> DataFrame:
    fields = ("risk_score", "credit_history", "debt_to_income", "risk_factors", "assessment_type", "model_version")
    return parsed(assessments, "risk_data_raw", RISK_SCHEMA, {f: f for f in fields})


def market_parsed(market: DataFrame) -> DataFrame:
    return parsed(
        market,
        "market_data_raw",
        MARKET_SCHEMA,
        {
            "open": "open_price",
            "high": "high_price",
            "low": "low_price",
            "close": "close_price",
            "volume": "volume",
            "indicators.moving_avg_50": "moving_avg_50",
            "indicators.rsi": "rsi",
            "indicators.macd": "macd",
        },
    )


def customer_profile(customers: DataFrame, accounts: DataFrame, assessments: DataFrame) -> DataFrame:
    """B1: customers with account totals and their latest assessment.

    Accounts and assessments are reduced to one row per customer before the joins, so the
    joins never multiply rows. A null assessment time never counts as latest.
    """
    totals = accounts.groupBy("customer_id").agg(
        F.countDistinct("account_id").alias("total_accounts"),
        F.sum(F.when(F.col("status") == "ACTIVE", 1).otherwise(0)).alias("active_accounts"),
        F.sum("balance").alias("total_balance"),
        F.sum("credit_limit").alias("total_credit_limit"),
    )
    latest = top_n_per_group(
        assessments,
        ["customer_id"],
        [F.desc_nulls_last("assessed_at"), F.desc_nulls_last("assessment_id")],
    )
    latest = risk_parsed(latest).select(
        "customer_id",
        F.col("risk_score").alias("latest_risk_score"),
        F.col("credit_history").alias("latest_credit_history"),
        "debt_to_income",
        F.col("assessed_at").alias("last_assessment_date"),
    )
    out = customers.join(totals, "customer_id", "left").join(latest, "customer_id", "left")
    zero = ("total_accounts", "active_accounts", "total_balance", "total_credit_limit")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)) for c in zero})


def transaction_enriched(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """B2: transactions with account and customer context.

    Accounts and customers have unique keys; a hot account only makes a skewed transaction
    partition, which adaptive execution splits.
    """
    a = accounts.select(
        "account_id",
        "account_type",
        F.col("balance").alias("account_balance"),
        F.col("status").alias("account_status"),
        "branch_code",
        "customer_id",
    )
    c = customers.select(
        "customer_id",
        "customer_name",
        F.col("city").alias("customer_city"),
        F.col("country").alias("customer_country"),
        "credit_score",
        "annual_income",
    )
    # The two lookups meet first: account rows are far fewer than transactions, so the
    # transaction side is shuffled once, on the account key. Whether the lookup is small
    # enough to broadcast is left to adaptive execution, which knows its real size.
    return transactions.join(a.join(c, "customer_id"), "account_id")


def support_enriched(tickets: DataFrame, customers: DataFrame, accounts: DataFrame, as_of: Column) -> DataFrame:
    """Tickets with customer context, account totals and age in hours."""
    totals = accounts.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("customer_accounts"), F.sum("balance").alias("customer_balance")
    )
    c = customers.select("customer_id", "customer_name", "city", "country", "credit_score", "annual_income")
    lookup = c.join(totals, "customer_id", "full")
    return (
        tickets.join(lookup, "customer_id", "left")
        .withColumn("customer_accounts", F.coalesce("customer_accounts", F.lit(0).cast("long")))
        .withColumn("ticket_age_hours", date_diff("hour", "created_at", as_of))
    )


def market_latest(market: DataFrame) -> DataFrame:
    """Latest price row per ticker; only the surviving rows are parsed."""
    last = top_n_per_group(market, ["ticker"], [F.desc_nulls_last("trade_date"), F.desc("market_data_id")])
    return market_parsed(last).drop("market_data_id")


def risk_factors_parsed(assessments: DataFrame) -> DataFrame:
    """One row per assessment and factor; assessments without factors keep one row."""
    return (
        risk_parsed(assessments)
        .withColumn("_factor", F.explode_outer("risk_factors"))
        .withColumns({"risk_factor": F.col("_factor.factor"), "factor_score": F.col("_factor.score")})
        .drop("risk_factors", "_factor")
    )


def compliance_enriched(documents: DataFrame) -> DataFrame:
    """Documents with their metadata fields and content length."""
    out = parsed(
        documents,
        "metadata_raw",
        METADATA_SCHEMA,
        {
            "regulatory_body": "regulatory_body",
            "status": "doc_status",
            "version": "doc_version",
            "effective_date": "effective_date",
            "review_cycle": "review_cycle",
            "classification": "classification",
        },
    )
    return out.withColumn("content_length", F.length("doc_content"))
