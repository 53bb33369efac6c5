"""Query registry and the SQL common table expressions shared by the twins."""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_FAMILIES = (
    "relational",
    "aggregates",
    "windows",
    "scalars",
    "derived",
    "metrics",
    "dashboards",
    "ingestion",
    "change",
    "quality",
    "policy",
    "text",
    "ml",
    "layout",
)


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`, with SQL over the same tables."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return wrap


def load_all() -> None:
    for family in _FAMILIES:
        importlib.import_module(f"{__package__}.{family}")


# One CTE per base or derived table; a twin names the ones it needs by using them.
VIEWS: dict[str, str] = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               CASE WHEN c_custkey % 50 = 0 THEN lower(c_name)
                    ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' END AS email,
               r_name AS city, n_name AS country, CAST(c_acctbal AS DECIMAL(18,2)) AS annual_income,
               c_mktsegment AS employment_status, CAST(300 + (c_custkey * 37) % 551 AS INTEGER) AS credit_score,
               DATE '1994-01-01' + CAST(c_custkey % 730 AS INTEGER) AS signup_date,
               DATE '1950-01-01' + CAST(c_custkey * 97 % 18250 AS INTEGER) AS date_of_birth
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "accounts": """
        SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderpriority AS account_type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
               CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 500000 ELSE 0 END AS DECIMAL(18,2)) AS credit_limit,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'INACTIVE' WHEN 'F' THEN 'CLOSED' END AS status,
               CAST(o_orderdate AS DATE) AS opened_date,
               'BR-' || lpad(CAST(o_custkey % 50 + 1 AS VARCHAR), 3, '0') AS branch_code
        FROM orders""",
    "transactions": """
        SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS account_id, l_shipdate AS txn_date,
               CASE l_returnflag WHEN 'N' THEN 'DEBIT' WHEN 'A' THEN 'CREDIT' WHEN 'R' THEN 'TRANSFER' END AS txn_type,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, s_name AS merchant_name, p_type AS category,
               CASE l_linenumber % 5 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'BRANCH' WHEN 2 THEN 'ATM'
                    WHEN 3 THEN 'MOBILE' ELSE 'POS' END AS channel,
               (l_returnflag = 'R' AND l_discount >= 0.08) AS is_flagged,
               l_linenumber AS line_number, l_partkey AS part_id, l_suppkey AS supplier_id,
               CAST(l_quantity AS DECIMAL(18,2)) AS quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "ev": """
        SELECT event_id, ts, user_id, event_type, value, CAST(props->>'$.k' AS INTEGER) AS k FROM events""",
    "risk_assessments": """
        SELECT event_id AS assessment_id, user_id AS customer_id, ts AS assessed_at, k AS risk_score,
               CASE WHEN k < 25 THEN 'EXCELLENT' WHEN k < 50 THEN 'GOOD' WHEN k < 75 THEN 'FAIR'
                    ELSE 'POOR' END AS credit_history,
               value / 500 AS debt_to_income,
               CASE WHEN k % 4 = 0 THEN 'ENHANCED' ELSE 'STANDARD' END AS assessment_type,
               'v2.3.' || CAST(k % 10 AS VARCHAR) AS model_version, event_type
        FROM ev""",
    "risk_factors": """
        SELECT r.*, f.pos, f.risk_factor, CAST(f.factor_score AS INTEGER) AS factor_score
        FROM risk_assessments r JOIN (
            SELECT assessment_id AS id, 0 AS pos, 'payment_history' AS risk_factor, risk_score AS factor_score
            FROM risk_assessments WHERE event_type = 'view'
            UNION ALL SELECT assessment_id, 1, 'credit_mix', risk_score * 7 % 100
            FROM risk_assessments WHERE event_type = 'view'
            UNION ALL SELECT assessment_id, 0, 'account_age', risk_score
            FROM risk_assessments WHERE event_type IN ('click', 'purchase')
            UNION ALL SELECT assessment_id, 1, 'new_accounts', risk_score * 3 % 100
            FROM risk_assessments WHERE event_type IN ('click', 'purchase')
            UNION ALL SELECT assessment_id, 2, 'public_records', risk_score * 11 % 100
            FROM risk_assessments WHERE event_type IN ('click', 'purchase')
            UNION ALL SELECT assessment_id, NULL, NULL, NULL
            FROM risk_assessments WHERE event_type IN ('signup', 'error')
        ) f ON r.assessment_id = f.id""",
    "market_data": """
        SELECT event_id AS market_data_id, event_type AS ticker, ts AS trade_date, value AS open_price,
               value + k AS high_price, value - k / 2.0::DOUBLE AS low_price,
               value + (k - 50) / 10.0::DOUBLE AS close_price,
               CAST(k * 1000 AS BIGINT) AS volume, CAST(k AS DOUBLE) AS rsi, (k - 50) / 10.0::DOUBLE AS macd,
               value AS moving_avg_50
        FROM ev""",
    "tickets": """
        SELECT event_id AS ticket_id, user_id AS customer_id, ts AS created_at, event_type || ' issue' AS subject,
               CASE k % 5 WHEN 0 THEN 'LOW' WHEN 3 THEN 'HIGH' WHEN 4 THEN 'CRITICAL' ELSE 'MEDIUM' END AS priority,
               CASE event_type WHEN 'view' THEN 'OPEN' WHEN 'click' THEN 'IN_PROGRESS' WHEN 'purchase' THEN 'RESOLVED'
                    WHEN 'signup' THEN 'CLOSED' WHEN 'error' THEN 'ESCALATED' END AS resolution_status,
               CASE user_id % 5 WHEN 0 THEN 'Support Team' WHEN 1 THEN 'Fraud Team' WHEN 2 THEN 'Card Services'
                    WHEN 3 THEN 'Tech Support' ELSE 'Compliance' END AS assigned_to
        FROM ev""",
    "compliance": """
        SELECT doc_id, source AS doc_type, text AS doc_content, lang,
               DATE '2023-01-01' + CAST(doc_id % 700 AS INTEGER) AS created_at,
               CASE doc_id % 6 WHEN 0 THEN 'OCC' WHEN 1 THEN 'FDIC' WHEN 2 THEN 'SEC' WHEN 3 THEN 'CFPB'
                    WHEN 4 THEN 'FinCEN' ELSE 'FRB' END AS regulatory_body,
               CASE doc_id % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'DRAFT' WHEN 2 THEN 'UNDER_REVIEW'
                    ELSE 'ARCHIVED' END AS doc_status,
               CAST(doc_id % 5 + 1 AS VARCHAR) || '.0' AS doc_version,
               CAST(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS VARCHAR) AS effective_date,
               CASE doc_id % 3 WHEN 0 THEN 'QUARTERLY' WHEN 1 THEN 'SEMI_ANNUAL' ELSE 'ANNUAL' END AS review_cycle,
               CASE (doc_id // 3) % 3 WHEN 0 THEN 'CONFIDENTIAL' WHEN 1 THEN 'INTERNAL'
                    ELSE 'PUBLIC' END AS classification,
               CAST(length(text) AS INTEGER) AS content_length
        FROM documents""",
    "enriched": """
        SELECT t.*, a.account_type, a.balance AS account_balance, a.status AS account_status, a.branch_code,
               a.customer_id, c.customer_name, c.city AS customer_city, c.country AS customer_country,
               c.credit_score, c.annual_income
        FROM transactions t JOIN accounts a ON t.account_id = a.account_id
        JOIN customers c ON a.customer_id = c.customer_id""",
    "profile": """
        SELECT c.*, COALESCE(a.total_accounts, 0) AS total_accounts, COALESCE(a.active_accounts, 0) AS active_accounts,
               COALESCE(a.total_balance, 0) AS total_balance, COALESCE(a.total_credit_limit, 0) AS total_credit_limit,
               r.risk_score AS latest_risk_score, r.credit_history AS latest_credit_history, r.debt_to_income,
               r.assessed_at AS last_assessment_date
        FROM customers c
        LEFT JOIN (SELECT customer_id, COUNT(DISTINCT account_id) AS total_accounts,
                          CAST(SUM(CASE WHEN status = 'ACTIVE' THEN 1 ELSE 0 END) AS BIGINT) AS active_accounts,
                          SUM(balance) AS total_balance, SUM(credit_limit) AS total_credit_limit
                   FROM accounts GROUP BY customer_id) a ON c.customer_id = a.customer_id
        LEFT JOIN (SELECT * FROM risk_assessments QUALIFY ROW_NUMBER() OVER (
                       PARTITION BY customer_id ORDER BY assessed_at DESC, assessment_id DESC) = 1
                  ) r ON c.customer_id = r.customer_id""",
    "c360": """
        SELECT p.customer_id, p.customer_name, p.email, p.city, p.country, p.annual_income, p.employment_status,
               p.credit_score, p.signup_date, p.total_accounts, p.active_accounts, p.total_balance,
               p.total_credit_limit, p.latest_risk_score, p.latest_credit_history, p.debt_to_income,
               COALESCE(x.total_transactions, 0) AS total_transactions, COALESCE(x.total_spent, 0) AS total_spent,
               COALESCE(x.avg_transaction, 0) AS avg_transaction,
               COALESCE(x.flagged_transactions, 0) AS flagged_transactions,
               COALESCE(x.days_since_last_txn, 999) AS days_since_last_txn,
               COALESCE(x.unique_merchants, 0) AS unique_merchants,
               COALESCE(x.unique_categories, 0) AS unique_categories,
               COALESCE(s.total_tickets, 0) AS total_tickets, COALESCE(s.open_tickets, 0) AS open_tickets,
               COALESCE(s.high_priority_tickets, 0) AS high_priority_tickets,
               CASE WHEN p.total_balance >= 200000 AND COALESCE(x.total_transactions, 0) >= 50 THEN 'PLATINUM'
                    WHEN p.total_balance >= 100000 AND COALESCE(x.total_transactions, 0) >= 25 THEN 'GOLD'
                    WHEN p.total_balance >= 25000 AND COALESCE(x.total_transactions, 0) >= 10 THEN 'SILVER'
                    ELSE 'STANDARD' END AS customer_segment
        FROM profile p
        LEFT JOIN (SELECT customer_id, COUNT(*) AS total_transactions,
                          SUM(CASE WHEN txn_type = 'DEBIT' THEN amount ELSE 0 END) AS total_spent,
                          CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_transaction,
                          CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_transactions,
                          DATE_DIFF('day', CAST(MAX(txn_date) AS DATE), DATE '2001-12-31') AS days_since_last_txn,
                          COUNT(DISTINCT merchant_name) AS unique_merchants,
                          COUNT(DISTINCT category) AS unique_categories
                   FROM enriched GROUP BY customer_id) x ON p.customer_id = x.customer_id
        LEFT JOIN (SELECT customer_id, COUNT(*) AS total_tickets,
                          CAST(SUM(CASE WHEN resolution_status IN ('OPEN', 'IN_PROGRESS') THEN 1 ELSE 0 END)
                               AS BIGINT) AS open_tickets,
                          CAST(SUM(CASE WHEN priority IN ('HIGH', 'CRITICAL') THEN 1 ELSE 0 END)
                               AS BIGINT) AS high_priority_tickets
                   FROM tickets GROUP BY customer_id) s ON p.customer_id = s.customer_id""",
    "churn": """
        SELECT customer_id, CAST(annual_income AS DOUBLE) AS annual_income, credit_score,
               DATE_DIFF('day', signup_date, DATE '2001-12-31') AS tenure_days, total_accounts, active_accounts,
               CAST(total_balance AS DOUBLE) AS total_balance,
               CAST(total_credit_limit AS DOUBLE) AS total_credit_limit,
               CASE WHEN total_credit_limit > 0
                    THEN ROUND(CAST(total_balance AS DOUBLE) / CAST(total_credit_limit AS DOUBLE), 4)
                    ELSE 0.0 END AS credit_utilization,
               total_transactions, CAST(total_spent AS DOUBLE) AS total_spent, avg_transaction, days_since_last_txn,
               unique_merchants, unique_categories, flagged_transactions,
               COALESCE(latest_risk_score, 50) AS risk_score, COALESCE(debt_to_income, 0.5) AS debt_to_income,
               total_tickets, open_tickets, high_priority_tickets,
               CASE WHEN days_since_last_txn > 90 THEN 1 WHEN active_accounts = 0 THEN 1 ELSE 0 END AS is_churned
        FROM c360""",
    "daily": """
        SELECT CAST(txn_date AS DATE) AS metric_date, COUNT(*) AS total_transactions,
               COUNT(DISTINCT customer_id) AS unique_customers, SUM(amount) AS total_volume,
               SUM(CASE WHEN txn_type = 'DEBIT' THEN amount ELSE 0 END) AS total_debits,
               SUM(CASE WHEN txn_type = 'CREDIT' THEN amount ELSE 0 END) AS total_credits,
               CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_transaction, MAX(amount) AS max_transaction,
               CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count,
               ROUND(CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / COUNT(*), 2) AS flagged_rate
        FROM enriched GROUP BY CAST(txn_date AS DATE)""",
    "channel_daily": """
        SELECT channel, CAST(txn_date AS DATE) AS metric_date, COUNT(*) AS transaction_count,
               SUM(amount) AS total_volume, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount,
               COUNT(DISTINCT customer_id) AS unique_customers,
               CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged_count,
               COUNT(DISTINCT category) AS categories_used
        FROM enriched GROUP BY channel, CAST(txn_date AS DATE)""",
    "monthly": """
        SELECT CAST(date_trunc('month', metric_date) AS DATE) AS revenue_month,
               CAST(SUM(total_transactions) AS BIGINT) AS monthly_transactions,
               CAST(SUM(unique_customers) AS BIGINT) AS monthly_active_customers,
               SUM(total_volume) AS monthly_volume, SUM(total_debits) AS monthly_debits,
               SUM(total_credits) AS monthly_credits, AVG(avg_transaction) AS avg_daily_txn_amount,
               MAX(max_transaction) AS peak_transaction, CAST(SUM(flagged_count) AS BIGINT) AS monthly_flags,
               AVG(flagged_rate) AS avg_flag_rate, COUNT(DISTINCT metric_date) AS trading_days
        FROM daily GROUP BY date_trunc('month', metric_date)""",
    "risk_board": """
        SELECT customer_id, customer_name, city, country, credit_score, total_balance, latest_risk_score,
               latest_credit_history, debt_to_income, total_accounts,
               CASE WHEN latest_risk_score >= 80 THEN 'CRITICAL' WHEN latest_risk_score >= 60 THEN 'HIGH'
                    WHEN latest_risk_score >= 40 THEN 'MEDIUM' WHEN latest_risk_score >= 20 THEN 'LOW'
                    ELSE 'MINIMAL' END AS risk_tier
        FROM profile WHERE latest_risk_score IS NOT NULL""",
    "market_latest": """
        SELECT ticker, trade_date, open_price, high_price, low_price, close_price, volume, moving_avg_50, rsi, macd
        FROM market_data
        QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trade_date DESC, market_data_id DESC) = 1""",
}


def with_views(sql: str) -> str:
    """Prefix the CTEs the statement uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str, skip: str | None = None) -> None:
        for name in VIEWS:
            if name != skip and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(VIEWS[name], name)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = sql.lstrip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
