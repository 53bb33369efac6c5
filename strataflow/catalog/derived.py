"""Curated and consumption tables (B)."""

from pyspark.sql import functions as F

from ..plans import consumption, curated
from ..sources.tables import TXN_TIE
from . import build
from .registry import query


@query(
    "b01_customer_profile",
    """SELECT customer_id, customer_name, email, country, employment_status, credit_score, total_accounts,
              active_accounts, CAST(total_balance AS DOUBLE) AS total_balance,
              CAST(total_credit_limit AS DOUBLE) AS total_credit_limit, latest_risk_score, latest_credit_history,
              debt_to_income, strftime(last_assessment_date, '%Y-%m-%d %H:%M:%S') AS last_assessment_date
       FROM profile""",
)
def b01(t):
    p = build.doubles(build.texts(build.profile(t), "last_assessment_date"), "total_balance", "total_credit_limit")
    return p.select(
        "customer_id", "customer_name", "email", "country", "employment_status", "credit_score", "total_accounts",
        "active_accounts", "total_balance", "total_credit_limit", "latest_risk_score", "latest_credit_history",
        "debt_to_income", "last_assessment_date",
    )


ENRICHED_COLUMNS = (
    "txn_id account_id txn_type amount merchant_name category channel is_flagged account_type account_balance "
    "account_status branch_code customer_id customer_name customer_city customer_country credit_score "
    "annual_income txn_date"
).split()


@query(
    "b02_transaction_enriched",
    """SELECT txn_id, account_id, txn_type, CAST(amount AS DOUBLE) AS amount, merchant_name, category, channel,
              is_flagged, account_type, CAST(account_balance AS DOUBLE) AS account_balance, account_status,
              branch_code, customer_id, customer_name, customer_city, customer_country, credit_score,
              CAST(annual_income AS DOUBLE) AS annual_income, strftime(txn_date, '%Y-%m-%d') AS txn_date
       FROM enriched""",
)
def b02(t):
    e = build.enriched(t).select(*ENRICHED_COLUMNS)
    return build.days(build.doubles(e, "amount", "account_balance", "annual_income"), "txn_date")


@query(
    "b03_support_enriched",
    f"""SELECT ticket_id, t.customer_id, subject, priority, resolution_status, assigned_to, customer_name, city, country,
              credit_score, CAST(annual_income AS DOUBLE) AS annual_income,
              (SELECT COUNT(*) FROM accounts a WHERE a.customer_id = t.customer_id) AS customer_accounts,
              (SELECT CAST(SUM(balance) AS DOUBLE) FROM accounts a WHERE a.customer_id = t.customer_id)
              AS customer_balance,
              DATE_DIFF('hour', created_at, TIMESTAMP '{build.AS_OF_TICKETS}') AS ticket_age_hours
       FROM tickets t LEFT JOIN customers c ON t.customer_id = c.customer_id""",
)
def b03(t):
    s = curated.support_enriched(
        t.tickets(), t.customers(), t.accounts(), F.lit(build.AS_OF_TICKETS).cast("timestamp_ntz")
    )
    return build.doubles(s, "annual_income", "customer_balance").drop("created_at")


@query(
    "b04_market_latest",
    """SELECT ticker, strftime(trade_date, '%Y-%m-%d %H:%M:%S') AS trade_date, open_price, high_price, low_price,
              close_price, volume, moving_avg_50, rsi, macd FROM market_latest""",
)
def b04(t):
    return build.texts(curated.market_latest(t.market_data()), "trade_date")


@query(
    "b05_risk_factors_parsed",
    """SELECT assessment_id, customer_id, risk_score, credit_history, debt_to_income, assessment_type, model_version,
              risk_factor, factor_score FROM risk_factors""",
)
def b05(t):
    return curated.risk_factors_parsed(t.risk_assessments()).drop("assessed_at")


@query(
    "b06_compliance_enriched",
    """SELECT doc_id, doc_type, lang, regulatory_body, doc_status, doc_version, effective_date, review_cycle,
              classification, content_length, md5(doc_content) AS content_md5 FROM compliance""",
)
def b06(t):
    c = curated.compliance_enriched(t.compliance_documents())
    return c.withColumn("content_md5", F.md5("doc_content")).drop("doc_content", "created_at")


C360_SQL = """SELECT customer_id, customer_name, country, credit_score, total_accounts, active_accounts,
       CAST(total_balance AS DOUBLE) AS total_balance, latest_risk_score, total_transactions,
       CAST(total_spent AS DOUBLE) AS total_spent, CAST(avg_transaction AS DOUBLE) AS avg_transaction,
       flagged_transactions, days_since_last_txn, unique_merchants, unique_categories, total_tickets, open_tickets,
       high_priority_tickets, customer_segment FROM c360"""


@query("b07_customer_360", C360_SQL)
def b07(t):
    return build.doubles(build.c360(t), "total_balance", "total_spent").select(
        "customer_id", "customer_name", "country", "credit_score", "total_accounts", "active_accounts",
        "total_balance", "latest_risk_score", "total_transactions", "total_spent", "avg_transaction",
        "flagged_transactions", "days_since_last_txn", "unique_merchants", "unique_categories", "total_tickets",
        "open_tickets", "high_priority_tickets", "customer_segment",
    )


@query(
    "b08_daily_financial_metrics",
    """SELECT strftime(metric_date, '%Y-%m-%d') AS metric_date, total_transactions, unique_customers,
              CAST(total_volume AS DOUBLE) AS total_volume, CAST(total_debits AS DOUBLE) AS total_debits,
              CAST(total_credits AS DOUBLE) AS total_credits, avg_transaction,
              CAST(max_transaction AS DOUBLE) AS max_transaction, flagged_count, flagged_rate FROM daily""",
)
def b08(t):
    d = build.doubles(build.daily(t), "total_volume", "total_debits", "total_credits", "max_transaction")
    return build.days(d, "metric_date")


@query(
    "b09_risk_dashboard",
    """SELECT customer_id, customer_name, city, country, credit_score, CAST(total_balance AS DOUBLE) AS total_balance,
              latest_risk_score, latest_credit_history, debt_to_income, total_accounts, risk_tier FROM risk_board""",
)
def b09(t):
    return build.doubles(build.risk_board(t), "total_balance")


@query(
    "b10_channel_performance",
    """SELECT channel, strftime(metric_date, '%Y-%m-%d') AS metric_date, transaction_count,
              CAST(total_volume AS DOUBLE) AS total_volume, avg_amount, unique_customers, flagged_count,
              categories_used FROM channel_daily""",
)
def b10(t):
    return build.days(build.doubles(build.channel_daily(t), "total_volume"), "metric_date")


@query("b11_churn_features", "SELECT * FROM churn")
def b11(t):
    return build.churn(t)


@query(
    "b12_monthly_revenue",
    """SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month, monthly_transactions, monthly_active_customers,
              CAST(monthly_volume AS DOUBLE) AS monthly_volume, CAST(monthly_debits AS DOUBLE) AS monthly_debits,
              CAST(monthly_credits AS DOUBLE) AS monthly_credits, ROUND(avg_daily_txn_amount, 4) AS avg_daily_txn_amount,
              CAST(peak_transaction AS DOUBLE) AS peak_transaction, monthly_flags,
              ROUND(avg_flag_rate, 4) AS avg_flag_rate, trading_days FROM monthly""",
)
def b12(t):
    m = build.doubles(build.monthly(t), "monthly_volume", "monthly_debits", "monthly_credits", "peak_transaction")
    return build.days(m, "revenue_month").withColumns(
        {c: F.round(c, 4) for c in ("avg_daily_txn_amount", "avg_flag_rate")}
    )


@query(
    "b13_market_overview",
    """SELECT ticker, close_price, open_price, volume,
              ROUND((close_price - open_price) / NULLIF(open_price, 0) * 100, 2) AS daily_return_pct, rsi, macd,
              CASE WHEN rsi > 70 THEN 'OVERBOUGHT' WHEN rsi < 30 THEN 'OVERSOLD' ELSE 'NEUTRAL' END AS rsi_signal,
              CASE WHEN macd > 0 THEN 'BULLISH' ELSE 'BEARISH' END AS macd_signal FROM market_latest""",
)
def b13(t):
    return consumption.market_overview(curated.market_latest(t.market_data())).select(
        "ticker", "close_price", "open_price", "volume", "daily_return_pct", "rsi", "macd", "rsi_signal", "macd_signal"
    )


@query(
    "b14_compliance_summary",
    """SELECT doc_type, regulatory_body, doc_status, classification, review_cycle, COUNT(*) AS doc_count,
              CAST(SUM(content_length) AS DOUBLE) / COUNT(*) AS avg_content_length,
              strftime(MIN(created_at), '%Y-%m-%d') AS earliest_doc, strftime(MAX(created_at), '%Y-%m-%d') AS latest_doc
       FROM compliance GROUP BY ALL""",
)
def b14(t):
    docs = curated.compliance_enriched(t.compliance_documents())
    return build.days(consumption.compliance_summary(docs), "earliest_doc", "latest_doc")


@query(
    "b15_risk_factor_summary",
    """SELECT risk_factor, credit_history, COUNT(*) AS assessment_count,
              CAST(SUM(risk_score) AS DOUBLE) / COUNT(risk_score) AS avg_risk_score,
              ROUND(AVG(debt_to_income), 6) AS avg_debt_to_income, MIN(risk_score) AS min_risk_score,
              MAX(risk_score) AS max_risk_score, CAST(SUM(factor_score) AS DOUBLE) / COUNT(factor_score)
              AS avg_factor_score FROM risk_factors GROUP BY risk_factor, credit_history""",
)
def b15(t):
    s = consumption.risk_factor_summary(curated.risk_factors_parsed(t.risk_assessments()))
    return s.withColumn("avg_debt_to_income", F.round("avg_debt_to_income", 6))


@query(
    "b16_metrics_snapshot",
    """SELECT '2001-12-31' AS metric_date, (SELECT COUNT(*) FROM customers) AS total_customers,
              (SELECT COUNT(*) FROM accounts) AS total_accounts,
              (SELECT CAST(SUM(balance) AS DOUBLE) FROM accounts WHERE status = 'ACTIVE') AS aum,
              (SELECT COUNT(*) FROM transactions) AS total_transactions,
              (SELECT CAST(SUM(amount) AS DOUBLE) FROM transactions) AS total_volume,
              (SELECT COUNT(*) FROM tickets) AS total_tickets""",
)
def b16(t):
    s = consumption.metrics_snapshot(
        t.customers(), t.accounts(), t.plain_transactions(), t.tickets(), build.as_of()
    )
    return build.days(build.doubles(s, "aum", "total_volume"), "metric_date")


@query(
    "b17_rfm_segmentation",
    """WITH base AS (SELECT customer_id, DATE_DIFF('day', CAST(MAX(txn_date) AS DATE), DATE '2001-12-31') AS recency_days,
                            COUNT(*) AS frequency, SUM(amount) AS monetary
                     FROM enriched WHERE txn_type = 'DEBIT' GROUP BY customer_id),
       scored AS (SELECT *, CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id) AS INTEGER) AS r_score,
                         CAST(NTILE(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS f_score,
                         CAST(NTILE(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS m_score FROM base)
       SELECT s.customer_id, customer_name, email, city, country, recency_days, frequency,
              CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score,
              CASE WHEN r_score + f_score + m_score >= 12 THEN 'Champions'
                   WHEN r_score + f_score + m_score >= 9 THEN 'Loyal Customers'
                   WHEN r_score + f_score + m_score >= 6 THEN 'Potential Loyalists' ELSE 'At Risk' END AS segment
       FROM scored s JOIN customers c ON s.customer_id = c.customer_id""",
)
def b17(t):
    r = consumption.rfm_segmentation(build.plain_enriched(t), t.customers(), build.as_of())
    return build.doubles(r, "monetary")


@query(
    "b18_enriched_using",
    """SELECT txn_id, account_id, line_number, part_id, account_type, customer_id, customer_name,
              customer_country, credit_score FROM enriched""",
)
def b18(t):
    a = t.accounts().select("account_id", "customer_id", "account_type")
    c = t.customers().select(
        "customer_id", "customer_name", F.col("country").alias("customer_country"), "credit_score"
    )
    x = t.plain_transactions().select("txn_id", "account_id", "line_number", "part_id")
    return x.join(a, "account_id").join(c, "customer_id")


@query(
    "b20_fraud_indicators",
    """SELECT * FROM (SELECT customer_id, customer_name, COUNT(*) AS total_txns,
              CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_txns,
              ROUND(CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / COUNT(*), 2) AS flag_rate,
              COUNT(DISTINCT channel) AS channels_used, COUNT(DISTINCT category) AS categories_used,
              COUNT(DISTINCT merchant_name) AS merchants_used,
              ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 4) AS amount_stddev,
              CAST(MAX(amount) - MIN(amount) AS DOUBLE) AS amount_range FROM enriched
              GROUP BY customer_id, customer_name) WHERE flagged_txns > 0
       ORDER BY flag_rate DESC, flagged_txns DESC, customer_id LIMIT 20""",
)
def b20(t):
    f = consumption.fraud_indicators(build.enriched(t), build.categories(t), build.channels(t))
    top = f.orderBy(F.desc("flag_rate"), F.desc("flagged_txns"), "customer_id").limit(20)
    return build.doubles(top, "amount_range").withColumn("amount_stddev", F.round("amount_stddev", 4))


@query(
    "b21_transaction_velocity",
    """SELECT event_id, user_id, n AS txns_last_hour, ROUND(total, 6) AS amount_last_hour FROM (
           SELECT event_id, user_id,
                  COUNT(*) OVER w AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts
                RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)) WHERE n >= 2""",
)
def b21(t):
    e = t.raw("events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("amount"))
    v = consumption.transaction_velocity(e, "user_id", "ts", "amount", minimum=2)
    return v.select(
        "event_id", "user_id", "txns_last_hour", F.round(F.col("amount_last_hour").cast("double"), 6).alias("amount_last_hour")
    )


@query(
    "b22_account_hierarchy",
    """WITH ranked AS (SELECT c.customer_id, customer_name, account_id, account_type, balance,
              CAST(RANK() OVER (PARTITION BY c.customer_id ORDER BY balance DESC) AS INTEGER) AS account_rank
              FROM customers c JOIN accounts a ON c.customer_id = a.customer_id WHERE status = 'ACTIVE'),
       best AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY amount DESC, txn_date, txn_type,
              line_number, part_id, supplier_id, quantity) AS INTEGER) AS txn_rank FROM transactions)
       SELECT r.customer_id, customer_name, r.account_id, account_type, CAST(balance AS DOUBLE) AS balance, account_rank,
              CAST(amount AS DOUBLE) AS top_txn_amount, category AS top_txn_category, txn_rank
       FROM ranked r JOIN best b ON r.account_id = b.account_id WHERE account_rank <= 2 AND txn_rank <= 3""",
)
def b22(t):
    h = consumption.account_hierarchy(
        t.customers(), t.accounts(), t.categorised_transactions(), [c for c in TXN_TIE if c != "amount"]
    )
    return h.select(
        "customer_id", "customer_name", "account_id", "account_type", F.col("balance").cast("double").alias("balance"),
        "account_rank", F.col("amount").cast("double").alias("top_txn_amount"),
        F.col("category").alias("top_txn_category"), "txn_rank",
    )


@query(
    "b23_anomaly_scores",
    """SELECT account_id, txn_id, line_number, part_id, supplier_id, t.category, CAST(amount AS DOUBLE) AS amount,
              avg_amount, CASE WHEN s.sd IS NULL OR s.sd = 0 THEN 0.0
              ELSE LEAST(ROUND(ABS((CAST(amount AS DOUBLE) - avg_amount) / s.sd) * 25, 2), 100.0) END AS anomaly_score
       FROM transactions t JOIN (SELECT category, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount,
            STDDEV_SAMP(CAST(amount AS DOUBLE)) AS sd FROM transactions GROUP BY category) s
       ON t.category = s.category""",
)
def b23(t):
    scored = consumption.anomaly_scores(t.categorised_transactions())
    return scored.select(
        "account_id", "txn_id", "line_number", "part_id", "supplier_id", "category",
        F.col("amount").cast("double").alias("amount"), "avg_amount", "anomaly_score",
    )


@query(
    "b24_composite_risk_tier",
    """SELECT customer_id, customer_name, credit_score, latest_risk_score, debt_to_income,
              CASE WHEN latest_risk_score IS NULL THEN 'UNASSESSED' WHEN comp >= 70 THEN 'CRITICAL'
                   WHEN comp >= 50 THEN 'HIGH' WHEN comp >= 30 THEN 'MEDIUM' WHEN comp >= 15 THEN 'LOW'
                   ELSE 'MINIMAL' END AS risk_tier
       FROM (SELECT *, latest_risk_score * 0.5::DOUBLE + COALESCE((850.0::DOUBLE - credit_score) / 850 * 30, 0)
                    + CASE WHEN debt_to_income IS NULL THEN 0 ELSE LEAST(debt_to_income * 20, 20.0::DOUBLE) END AS comp
             FROM profile)""",
)
def b24(t):
    return consumption.composite_risk(build.profile(t))


@query(
    "b26_high_balance_customers",
    """SELECT p.customer_id, p.customer_name, CAST(p.total_balance AS DOUBLE) AS total_balance, x.txn_count,
              CAST(x.total_amount AS DOUBLE) AS total_amount
       FROM profile p LEFT JOIN (SELECT customer_id, COUNT(*) AS txn_count, SUM(amount) AS total_amount
            FROM enriched GROUP BY customer_id) x ON p.customer_id = x.customer_id WHERE p.total_balance > 2000000""",
)
def b26(t):
    h = consumption.high_balance_customers(build.profile(t), build.plain_enriched(t), 2000000)
    return build.doubles(h, "total_balance", "total_amount")
