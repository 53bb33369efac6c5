"""Dashboard and exploration data sets (D) and the summary reports B19 and B25."""

from pyspark.sql import functions as F

from ..functions.compat import dbl_avg, json_get
from ..operators import reshape
from ..operators.quantiles import group_summary
from ..plans import consumption, curated, dashboards
from . import build
from .aggregates import COUNTS_SQL, ROLLUP_SQL, base_tables, ticket_funnel
from .registry import query


@query(
    "d01_kpi_row",
    """SELECT (SELECT CAST(SUM(total_volume) AS DOUBLE) FROM daily) AS total_volume,
              (SELECT CAST(SUM(total_transactions) AS BIGINT) FROM daily) AS transactions,
              (SELECT COUNT(*) FROM profile) AS customers, (SELECT CAST(SUM(total_balance) AS DOUBLE) FROM profile) AS assets""",
)
def d01(t):
    return dashboards.kpi_row(build.daily(t), build.profile(t))


@query(
    "d02_daily_series",
    """SELECT strftime(metric_date, '%Y-%m-%d') AS metric_date, CAST(total_volume AS DOUBLE) AS total_volume, flagged_rate
       FROM daily""",
)
def d02(t):
    d = build.doubles(build.daily(t).select("metric_date", "total_volume", "flagged_rate"), "total_volume")
    return build.days(d, "metric_date").orderBy("metric_date")


@query("d03_tier_distribution", "SELECT risk_tier, COUNT(*) AS n FROM risk_board GROUP BY risk_tier")
def d03(t):
    return reshape.value_counts(build.risk_board(t), "risk_tier")


@query(
    "d03_score_balance_points",
    """SELECT customer_id, latest_risk_score, CAST(total_balance AS DOUBLE) AS total_balance, risk_tier FROM risk_board""",
)
def d03b(t):
    return build.doubles(build.risk_board(t), "total_balance").select(
        "customer_id", "latest_risk_score", "total_balance", "risk_tier"
    )


@query(
    "d04_churn_overview",
    """SELECT is_churned, COUNT(*) AS customers, ROUND(AVG(total_balance), 4) AS avg_balance,
              ROUND(AVG(total_transactions), 6) AS avg_transactions, ROUND(AVG(days_since_last_txn), 6) AS avg_idle_days
       FROM churn GROUP BY is_churned""",
)
def d04(t):
    return dashboards.churn_overview(build.churn(t))


@query(
    "d04_top_customers",
    """SELECT customer_id, customer_name, CAST(total_balance AS DOUBLE) AS total_balance FROM profile
       ORDER BY total_balance DESC, customer_id LIMIT 20""",
)
def d04b(t):
    return build.doubles(dashboards.top_customers(build.profile(t)), "total_balance").select(
        "customer_id", "customer_name", "total_balance"
    )


@query("d04_top_countries", "SELECT country, COUNT(*) AS customers FROM customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def d04c(t):
    return dashboards.top_countries(t.customers())


@query(
    "d05_channel_totals",
    """SELECT channel, CAST(SUM(transaction_count) AS BIGINT) AS transactions, CAST(SUM(total_volume) AS DOUBLE) AS volume,
              CAST(SUM(flagged_count) AS BIGINT) AS flagged FROM channel_daily GROUP BY channel""",
)
def d05(t):
    return dashboards.channel_totals(build.channel_daily(t))


@query("d06_base_row_counts", COUNTS_SQL)
def d06(t):
    return reshape.labelled_counts(base_tables(t))


@query(
    "d07_customers_by_country",
    """SELECT country, COUNT(*) AS customers, CAST(SUM(annual_income) AS DOUBLE) / COUNT(*) AS avg_income,
              CAST(SUM(credit_score) AS DOUBLE) / COUNT(*) AS avg_credit FROM customers GROUP BY country""",
)
def d07(t):
    return dashboards.customers_by_country(t.customers())


GROUPED_SQL = """SELECT {keys}, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) AS total_volume,
       CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount FROM transactions GROUP BY {keys}"""


@query("d08_volume_by_category", GROUPED_SQL.format(keys="category"))
def d08(t):
    return dashboards.grouped_volume(t.categorised_transactions(), "category")


@query("d08_volume_by_channel", GROUPED_SQL.format(keys="channel"))
def d08b(t):
    return dashboards.grouped_volume(t.plain_transactions(), "channel")


@query(
    "d09_risk_by_credit_history",
    """SELECT credit_history, COUNT(*) AS n, CAST(SUM(risk_score) AS DOUBLE) / COUNT(*) AS avg_score FROM risk_assessments
       GROUP BY credit_history""",
)
def d09(t):
    doc = F.parse_json("risk_data_raw")
    r = t.risk_assessments().select(
        json_get(doc, "$.credit_history", "string").alias("credit_history"),
        json_get(doc, "$.risk_score", "int").alias("risk_score"),
    )
    return r.groupBy("credit_history").agg(F.count("*").alias("n"), dbl_avg("risk_score").alias("avg_score"))


@query(
    "d09_market_parsed",
    "SELECT market_data_id, ticker, open_price, high_price, low_price, close_price, volume, rsi FROM market_data",
)
def d09b(t):
    return curated.market_parsed(t.market_data()).select(
        "market_data_id", "ticker", "open_price", "high_price", "low_price", "close_price", "volume", "rsi"
    )


@query("d10_ticket_funnel", ROLLUP_SQL)
def d10(t):
    return ticket_funnel(t)


@query(
    "d11_percentiles_by_category",
    """SELECT category, COUNT(*) AS txn_count, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS avg_amount,
              ROUND(MEDIAN(CAST(amount AS DOUBLE)), 4) AS median_amount,
              ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.25), 4) AS p25,
              ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.75), 4) AS p75,
              ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.95), 4) AS p95, CAST(MAX(amount) AS DOUBLE) AS max_amount
       FROM transactions GROUP BY category""",
)
def d11(t):
    names = {"median_amount": 0.5, "p25": 0.25, "p75": 0.75, "p95": 0.95}
    x = group_summary(t.categorised_transactions(), ["category"], "amount", names)
    return x.select(
        "category", F.col("n_rows").alias("txn_count"), (F.col("total").cast("double") / F.col("n_values")).alias("avg_amount"),
        F.col("highest").cast("double").alias("max_amount"), *[F.round(n, 4).alias(n) for n in names],
    )


@query(
    "d12_spot_check",
    """SELECT account_id, txn_id, part_id, supplier_id, CAST(amount AS DOUBLE) AS amount FROM transactions WHERE is_flagged
       ORDER BY amount DESC, account_id, txn_id, part_id, supplier_id LIMIT 10""",
)
def d12(t):
    keys = ("account_id", "txn_id", "part_id", "supplier_id")
    x = t.plain_transactions().where("is_flagged").orderBy(F.desc("amount"), *keys).limit(10)
    return x.select(*keys, F.col("amount").cast("double").alias("amount"))


TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


@query(
    "d13_table_listing",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}"
        for n in TABLE_NAMES
    ),
)
def d13(t):
    return reshape.labelled_counts({n: t.raw(n) for n in TABLE_NAMES})


@query("d14_volume_category_channel", GROUPED_SQL.format(keys="category, channel"))
def d14(t):
    return dashboards.grouped_volume(t.categorised_transactions(), "category", "channel").orderBy(
        F.desc("total_volume")
    )


@query(
    "d15_overall_join_totals",
    """SELECT COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS total, CAST(SUM(amount) AS DOUBLE) / COUNT(*) AS mean FROM enriched""",
)
def d15(t):
    return build.plain_enriched(t).agg(
        F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"), dbl_avg("amount").alias("mean")
    )


#: Layer, object, type, and what counts its rows: a table of SQL, or a query.
OBJECTS = (
    ("base", "customers", "table", "customers"),
    ("base", "accounts", "table", "accounts"),
    ("base", "transactions", "table", "transactions"),
    ("base", "risk_assessments", "table (variant)", "risk_assessments"),
    ("base", "market_data", "table (variant)", "market_data"),
    ("base", "support_tickets", "table (text)", "tickets"),
    ("base", "compliance_documents", "table (text, variant)", "compliance"),
    ("curated", "customer_profile", "derived table", "profile"),
    ("curated", "transaction_enriched", "derived table", "enriched"),
    ("curated", "support_enriched", "derived table", "tickets"),
    ("curated", "market_latest", "derived table", "market_latest"),
    ("curated", "risk_factors_parsed", "derived table", "risk_factors"),
    ("curated", "compliance_enriched", "derived table", "compliance"),
    ("consumption", "customer_360", "derived table", "c360"),
    ("consumption", "daily_financial_metrics", "derived table", "daily"),
    ("consumption", "risk_dashboard", "derived table", "risk_board"),
    ("consumption", "channel_performance", "derived table", "channel_daily"),
    ("consumption", "churn_features", "derived table", "churn"),
    ("consumption", "monthly_revenue", "derived table", "monthly"),
    ("consumption", "market_overview", "derived table", "market_latest"),
    ("consumption", "compliance_summary", "derived table", "(SELECT DISTINCT doc_type, regulatory_body, doc_status, classification, review_cycle FROM compliance)"),
    ("consumption", "risk_factor_summary", "derived table", "(SELECT DISTINCT risk_factor, credit_history FROM risk_factors)"),
    ("consumption", "customer_rfm", "stored table", "(SELECT DISTINCT c.customer_id FROM enriched e JOIN customers c ON e.customer_id = c.customer_id WHERE txn_type = 'DEBIT')"),
    ("consumption", "not_there", "stored table", None),
)


@query(
    "b19_layer_summary",
    " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS object_name, '{kind}' AS object_type, "
        + (f"(SELECT COUNT(*) FROM {source}) AS row_count" if source else "CAST(-1 AS BIGINT) AS row_count")
        for layer, name, kind, source in OBJECTS
    ),
)
def b19(t):
    from ..operators.quality import layer_summary

    profile, enriched, market = build.profile(t), build.plain_enriched(t), curated.market_latest(t.market_data())
    factors, documents = curated.risk_factors_parsed(t.risk_assessments()), curated.compliance_enriched(t.compliance_documents())
    tables = {
        "customers": t.customers(),
        "accounts": t.accounts(),
        "transactions": t.plain_transactions(),
        "risk_assessments": t.risk_assessments(),
        "market_data": t.market_data(),
        "support_tickets": t.tickets(),
        "compliance_documents": t.compliance_documents(),
        "customer_profile": profile,
        "transaction_enriched": enriched,
        "support_enriched": curated.support_enriched(t.tickets(), t.customers(), t.accounts(), F.lit(build.AS_OF_TICKETS).cast("timestamp_ntz")),
        "market_latest": market,
        "risk_factors_parsed": factors,
        "compliance_enriched": documents,
        "customer_360": build.c360(t),
        "daily_financial_metrics": build.daily(t),
        "risk_dashboard": build.risk_board(t),
        "channel_performance": build.channel_daily(t),
        "churn_features": build.churn(t),
        "monthly_revenue": build.monthly(t),
        "market_overview": consumption.market_overview(market),
        "compliance_summary": consumption.compliance_summary(documents),
        "risk_factor_summary": consumption.risk_factor_summary(factors),
        "customer_rfm": consumption.rfm_segmentation(enriched, t.customers(), build.as_of()),
        "not_there": None,
    }
    counts = layer_summary(t.spark, tables).withColumnRenamed("table_name", "object_name")
    listed = t.spark.createDataFrame([o[:3] for o in OBJECTS], "layer string, object_name string, object_type string")
    return listed.join(counts, "object_name")
