"""Fixed schemas of base and landing tables, as DDL text."""


# Column names and types of the model.
CUSTOMERS = (
    "customer_id bigint, first_name string, last_name string, email string, phone string, date_of_birth date, "
    "city string, state string, country string, annual_income decimal(12,2), employment_status string, "
    "credit_score decimal(4,0), signup_date timestamp"
)
ACCOUNTS = (
    "account_id bigint, customer_id bigint, account_type string, balance decimal(15,2), credit_limit decimal(15,2), "
    "interest_rate decimal(6,4), opened_date date, status string, branch_code string"
)
TRANSACTIONS = (
    "txn_id bigint, account_id bigint, txn_date timestamp, txn_type string, amount decimal(12,2), "
    "merchant_name string, category string, channel string, is_flagged boolean"
)
TICKETS = (
    "ticket_id bigint, customer_id bigint, created_at timestamp, subject string, priority string, body string, "
    "resolution_status string, assigned_to string"
)
RISK_ASSESSMENTS = "assessment_id bigint, customer_id bigint, assessed_at timestamp, risk_data_raw string"
MARKET_DATA = "market_data_id bigint, ticker string, trade_date date, market_data_raw string"
COMPLIANCE_DOCUMENTS = (
    "doc_id bigint, doc_type string, doc_content string, metadata_raw string, created_at timestamp"
)


def without_key(ddl: str) -> str:
    """Landing form of a base table: its columns without the generated key."""
    return ddl.split(", ", 1)[1]


LANDED_TRANSACTIONS = without_key(TRANSACTIONS)
LANDED_TICKETS = without_key(TICKETS)
LANDED_ASSESSMENTS = without_key(RISK_ASSESSMENTS)
