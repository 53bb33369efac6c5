"""Quality and monitoring queries (Q)."""

from pyspark.sql import functions as F

from ..functions.compat import json_get
from ..operators import quality as q
from ..operators.joins import missing_from
from . import build
from .aggregates import COUNTS_SQL, base_tables
from .dashboards import TABLE_NAMES
from .registry import query

STAMP = "2001-12-31 00:00:00"


def _checks():
    return [
        q.null_check("transactions", "account_id"),
        q.future_check("transactions", "txn_date", F.lit("2001-06-01").cast("timestamp_ntz")),
        q.range_check("customers", "credit_score", 320, 830),
        q.format_check("customers", "email", "%_@_%.__%"),
        q.negative_check("customers", "annual_income"),
        q.negative_check("accounts", "balance"),
    ]


CHECK_SQL = """
    SELECT 'transactions' AS table_name, 'account_id' AS column_name, 'null_account_id' AS metric_name,
           CAST(COUNT_IF(account_id IS NULL) AS BIGINT) AS issue_count FROM transactions
    UNION ALL SELECT 'transactions', 'txn_date', 'future_txn_date',
           CAST(COUNT_IF(txn_date > TIMESTAMP '2001-06-01') AS BIGINT) FROM transactions
    UNION ALL SELECT 'customers', 'credit_score', 'credit_score_range',
           CAST(COUNT_IF(credit_score < 320 OR credit_score > 830) AS BIGINT) FROM customers
    UNION ALL SELECT 'customers', 'email', 'email_format',
           CAST(COUNT_IF(email IS NOT NULL AND email NOT LIKE '%_@_%.__%') AS BIGINT) FROM customers
    UNION ALL SELECT 'customers', 'annual_income', 'negative_annual_income',
           CAST(COUNT_IF(annual_income < 0) AS BIGINT) FROM customers
    UNION ALL SELECT 'accounts', 'balance', 'negative_balance', CAST(COUNT_IF(balance < 0) AS BIGINT) FROM accounts"""


def _run(t):
    tables = {"transactions": t.plain_transactions(), "customers": t.customers(), "accounts": t.accounts()}
    return q.run_checks(tables, _checks(), F.lit(STAMP))


@query("q01_check_registry", f"SELECT '{STAMP}' AS measurement_time, * FROM ({CHECK_SQL})")
def q01(t):
    return _run(t)


@query(
    "q02_null_keys",
    """SELECT CAST(COUNT_IF(account_id IS NULL) AS BIGINT) AS null_account,
              CAST(COUNT_IF(txn_date IS NULL) AS BIGINT) AS null_date FROM transactions""",
)
def q02(t):
    return t.plain_transactions().agg(
        F.count_if(F.col("account_id").isNull()).alias("null_account"),
        F.count_if(F.col("txn_date").isNull()).alias("null_date"),
    )


@query(
    "q03_json_range",
    """SELECT CAST(COUNT_IF(risk_score < 5 OR risk_score > 95) AS BIGINT) AS out_of_range,
              CAST(COUNT_IF(risk_score IS NULL) AS BIGINT) AS missing FROM risk_assessments""",
)
def q03(t):
    score = json_get(F.try_parse_json("risk_data_raw"), "$.risk_score", "int", strict=False)
    r = t.risk_assessments().select(score.alias("risk_score"))
    return r.agg(
        F.count_if((F.col("risk_score") < 5) | (F.col("risk_score") > 95)).alias("out_of_range"),
        F.count_if(F.col("risk_score").isNull()).alias("missing"),
    )


@query(
    "q04_format_check",
    "SELECT CAST(COUNT_IF(email NOT LIKE '%_@_%.__%') AS BIGINT) AS bad_email, COUNT(*) AS n FROM customers",
)
def q04(t):
    return t.customers().agg(
        F.count_if(~F.col("email").like("%_@_%.__%")).alias("bad_email"), F.count("*").alias("n")
    )


@query(
    "q05_negative_and_future",
    """SELECT CAST(COUNT_IF(annual_income < 0) AS BIGINT) AS negative_income,
              CAST(COUNT_IF(signup_date > DATE '1995-06-01') AS BIGINT) AS future_signup FROM customers""",
)
def q05(t):
    return t.customers().agg(
        F.count_if(F.col("annual_income") < 0).alias("negative_income"),
        F.count_if(F.col("signup_date") > F.lit("1995-06-01").cast("date")).alias("future_signup"),
    )


@query(
    "q06_orphan_keys",
    """SELECT COUNT(*) AS orphans FROM transactions t WHERE NOT EXISTS
       (SELECT 1 FROM accounts a WHERE a.account_id = t.account_id AND a.status <> 'CLOSED')""",
)
def q06(t):
    return q.orphan_count(t.plain_transactions(), t.accounts().where(F.col("status") != "CLOSED"), ["account_id"])


@query(
    "q07_key_uniqueness",
    """SELECT CAST((SELECT COUNT(*) FROM lineitem WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS BIGINT) AS null_keys,
              (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)) AS duplicate_keys""",
)
def q07(t):
    return q.key_violations(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q08_unmerged_rows",
    """SELECT COUNT(*) AS landed, CAST(COUNT_IF(m.event_id IS NULL) AS BIGINT) AS unmerged FROM events e LEFT JOIN
       (SELECT event_id FROM events WHERE event_type <> 'error') m ON e.event_id = m.event_id""",
)
def q08(t):
    landed = t.raw("events").select("event_id", "event_type")
    merged = landed.where(F.col("event_type") != "error")
    from ..operators.reshape import combine_single_rows

    return combine_single_rows(
        [
            landed.agg(F.count("*").alias("landed")),
            missing_from(landed, merged, ["event_id"]).agg(F.count("*").alias("unmerged")),
        ]
    )


@query(
    "q09_layer_counts",
    COUNTS_SQL
    + """ UNION ALL SELECT 'enriched', COUNT(*) FROM enriched UNION ALL SELECT 'profile', COUNT(*) FROM profile
       UNION ALL SELECT 'market_latest', COUNT(*) FROM market_latest UNION ALL SELECT 'risk_factors', COUNT(*) FROM risk_factors
       UNION ALL SELECT 'daily', COUNT(*) FROM daily UNION ALL SELECT 'channel_daily', COUNT(*) FROM channel_daily""",
)
def q09(t):
    from ..plans import curated

    tables = base_tables(t)
    tables["enriched"] = build.plain_enriched(t)
    tables["profile"] = build.profile(t)
    tables["market_latest"] = curated.market_latest(t.market_data())
    tables["risk_factors"] = curated.risk_factors_parsed(t.risk_assessments())
    tables["daily"] = build.daily(t)
    tables["channel_daily"] = build.channel_daily(t)
    return q.layer_summary(t.spark, tables)


@query("q10_label_distribution", "SELECT quality, toxic, COUNT(*) AS n FROM labels GROUP BY quality, toxic")
def q10(t):
    from ..operators.reshape import value_counts

    return value_counts(t.raw("labels"), "quality", "toxic")


@query(
    "q11_latest_results",
    f"""SELECT '{STAMP}' AS measurement_time, * FROM ({CHECK_SQL}) ORDER BY table_name, column_name, metric_name LIMIT 4""",
)
def q11(t):
    return q.latest_results(_run(t), 4)


@query(
    "q12_usage_by_role",
    """SELECT event_type AS role_name, COUNT(*) AS query_count, COUNT(DISTINCT user_id) AS unique_users,
              CAST(COUNT_IF(k > 90) AS BIGINT) AS failed_queries FROM ev GROUP BY event_type""",
)
def q12(t):
    log = t.raw("events").select(
        F.col("event_type").alias("role_name"), "user_id",
        json_get(F.parse_json("props"), "$.k", "int").alias("k"),
    )
    return q.usage_summary(log, "role_name", "user_id", F.col("k") > 90)


@query(
    "q13_failed_attempts",
    """SELECT user_id, k // 10 AS code, COUNT(*) AS attempts, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_attempt
       FROM ev WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-29' - INTERVAL 7 DAY AND ts < TIMESTAMP '2024-01-29'
       GROUP BY user_id, k // 10""",
)
def q13(t):
    log = t.raw("events").withColumn("code", F.expr("cast(variant_get(parse_json(props), '$.k', 'int') div 10 as int)"))
    r = q.failed_attempts(
        log, F.col("event_type") == "error", "ts", F.lit("2024-01-29").cast("timestamp_ntz"), 7, ["user_id", "code"]
    )
    return build.texts(r, "last_attempt")


@query(
    "q14_object_access",
    """SELECT event_id, user_id FROM ev WHERE event_type IN ('view', 'purchase') AND k % 2 = 0""",
)
def q14(t):
    k = json_get(F.parse_json("props"), "$.k", "int")

    def item(name):
        return F.struct(name.alias("object_name"))

    objects = F.array(
        item(F.when(F.col("event_type").isin("view", "purchase") & (k % 2 == 0), F.lit("base.customers")).otherwise("base.other")),
        item(F.concat(F.lit("base."), F.col("event_type"))),
    )
    log = t.raw("events").select("event_id", "user_id", objects.alias("objects"))
    return q.accessed_any(log, "objects", "object_name", ["base.customers"]).select("event_id", "user_id")


@query(
    "q15_performance_summary",
    """SELECT event_type AS run_name, COUNT(*) AS runs, ROUND(AVG(value), 4) AS avg_seconds, CAST(SUM(k) AS BIGINT) AS rows_out,
              ROUND(CAST(SUM(k) AS DOUBLE) * 100.0 / SUM(k + 50), 2) AS read_pct,
              ROUND(CAST(SUM(k // 2) AS DOUBLE) * 100.0 / SUM(k), 2) AS cached_pct FROM ev GROUP BY event_type""",
)
def q15(t):
    k = json_get(F.parse_json("props"), "$.k", "int")
    runs = t.raw("events").select(
        F.col("event_type").alias("run_name"), F.col("value").alias("seconds"), k.alias("rows_out"), k.alias("parts_read"),
        (k + 50).alias("parts_total"), F.floor(k / 2).alias("parts_cached"),
    )
    return q.performance_summary(runs, "run_name")


@query(
    "q16_table_files",
    " UNION ALL ".join(
        f"SELECT '{n}.parquet' AS file_name, COUNT(*) AS row_count FROM {n}" for n in TABLE_NAMES
    ),
)
def q16(t):
    from ..operators.reshape import union_all

    # The query checks one file per table; on a cluster a table lists its part files.
    return union_all([q.file_listing(t.raw(n)) for n in TABLE_NAMES]).drop("file_size")
