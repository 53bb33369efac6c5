"""Metric-layer queries (M)."""

from pyspark.sql import functions as F

from ..plans.metrics import FINANCE_MODEL, metric_query
from . import build
from .registry import query


def ask(table, source, measures, dims=(), **kw):
    return metric_query(FINANCE_MODEL, table, source, measures, dims, **kw)


@query(
    "m01_measures_by_dimension",
    """SELECT employment_status, country, CAST(SUM(total_balance) AS DOUBLE) AS total_balance,
              CAST(SUM(total_transactions) AS BIGINT) AS total_transactions,
              CAST(SUM(credit_score) AS DOUBLE) / COUNT(credit_score) AS credit_score
       FROM c360 GROUP BY employment_status, country""",
)
def m01(t):
    r = ask(
        "customer_360", build.c360(t), ["total_balance", "total_transactions", "credit_score"],
        ["employment_status", "country"],
    )
    return build.doubles(r, "total_balance")


@query("m02_constant_measure", "SELECT customer_segment, COUNT(*) AS customer_count FROM c360 GROUP BY customer_segment")
def m02(t):
    return ask("customer_360", build.c360(t), ["customer_count"], ["customer_segment"])


@query(
    "m03_time_grain",
    """SELECT strftime(date_trunc('quarter', metric_date), '%Y-%m-%d') AS metric_date_ts,
              CAST(SUM(total_transactions) AS BIGINT) AS total_transactions, CAST(SUM(flagged_count) AS BIGINT) AS flagged_count
       FROM daily GROUP BY 1""",
)
def m03(t):
    r = ask(
        "daily_financial_metrics", build.daily(t), ["total_transactions", "flagged_count"], ["metric_date_ts"],
        grain="quarter",
    )
    return build.days(r, "metric_date_ts")


@query(
    "m04_customers_by_segment",
    "SELECT customer_segment, COUNT(*) AS customer_count FROM c360 GROUP BY customer_segment ORDER BY 2 DESC",
)
def m04a(t):
    return ask("customer_360", build.c360(t), ["customer_count"], ["customer_segment"], order=[F.desc("customer_count")])


@query(
    "m04_volume_by_channel",
    "SELECT channel, CAST(SUM(total_volume) AS DOUBLE) AS total_volume FROM channel_daily GROUP BY channel",
)
def m04b(t):
    r = ask("channel_performance", build.channel_daily(t), ["total_volume"], ["channel"], order=[F.desc("total_volume")])
    return build.doubles(r, "total_volume")


@query(
    "m04_daily_flagged_rate",
    """SELECT strftime(metric_date, '%Y-%m-%d') AS metric_date, flagged_rate FROM daily
       WHERE metric_date >= DATE '2001-06-30' - 30 AND metric_date <= DATE '2001-06-30'""",
)
def m04c(t):
    as_of = F.lit("2001-06-30").cast("date")
    day = F.col("metric_date")
    r = ask(
        "daily_financial_metrics", build.daily(t), ["flagged_rate"], ["metric_date"],
        where=(day >= F.date_sub(as_of, 30)) & (day <= as_of), order=[F.asc("metric_date")],
    )
    return build.days(r, "metric_date")


@query(
    "m04_top_customers_by_balance",
    """SELECT customer_id, customer_name, customer_segment, CAST(total_balance AS DOUBLE) AS total_balance, total_transactions
       FROM c360 ORDER BY total_balance DESC, customer_id LIMIT 10""",
)
def m04d(t):
    r = ask(
        "customer_360", build.c360(t), ["total_balance", "total_transactions"],
        ["customer_id", "customer_name", "customer_segment"],
        order=[F.desc("total_balance"), F.asc("customer_id")], limit=10,
    )
    return build.doubles(r, "total_balance")


@query(
    "m04_customers_by_risk_tier",
    "SELECT risk_tier, COUNT(*) AS customer_count FROM risk_board GROUP BY risk_tier",
)
def m04e(t):
    return ask("risk_dashboard", build.risk_board(t), ["customer_count"], ["risk_tier"], order=[F.desc("customer_count")])


@query(
    "m05_credit_by_segment",
    """SELECT customer_segment, CAST(SUM(credit_score) AS DOUBLE) / COUNT(*) AS credit_score,
              CAST(SUM(total_balance) AS DOUBLE) AS total_balance, CAST(SUM(total_spent) AS DOUBLE) AS total_spent
       FROM c360 GROUP BY customer_segment""",
)
def m05a(t):
    r = ask("customer_360", build.c360(t), ["credit_score", "total_balance", "total_spent"], ["customer_segment"])
    return build.doubles(r, "total_balance", "total_spent")


@query(
    "m05_highest_average_channel",
    """SELECT channel, ROUND(AVG(avg_amount), 4) AS avg_amount FROM channel_daily GROUP BY channel
       ORDER BY AVG(avg_amount) DESC, channel LIMIT 1""",
)
def m05b(t):
    r = ask("channel_performance", build.channel_daily(t), ["avg_amount"], ["channel"],
            order=[F.desc("avg_amount"), F.asc("channel")], limit=1)
    return r.withColumn("avg_amount", F.round("avg_amount", 4))


@query(
    "m05_monthly_trend",
    """SELECT strftime(date_trunc('month', metric_date), '%Y-%m-%d') AS metric_date_ts,
              CAST(SUM(total_volume) AS DOUBLE) AS total_volume FROM daily GROUP BY 1""",
)
def m05c(t):
    r = ask("daily_financial_metrics", build.daily(t), ["total_volume"], ["metric_date_ts"], grain="month",
            order=[F.asc("metric_date_ts")])
    return build.days(build.doubles(r, "total_volume"), "metric_date_ts")


@query(
    "m05_channel_comparison",
    """SELECT channel, CAST(SUM(transaction_count) AS BIGINT) AS transaction_count,
              CAST(SUM(total_volume) AS DOUBLE) AS total_volume FROM channel_daily
       WHERE channel IN ('ONLINE', 'POS') GROUP BY channel""",
)
def m05d(t):
    r = ask("channel_performance", build.channel_daily(t), ["transaction_count", "total_volume"], ["channel"],
            where=F.col("channel").isin("ONLINE", "POS"))
    return build.doubles(r, "total_volume")


@query(
    "m05_average_risk_in_tier",
    "SELECT CAST(SUM(latest_risk_score) AS DOUBLE) / COUNT(*) AS latest_risk_score FROM risk_board WHERE risk_tier = 'CRITICAL'",
)
def m05e(t):
    return ask("risk_dashboard", build.risk_board(t), ["latest_risk_score"], where=F.col("risk_tier") == "CRITICAL")


@query(
    "m05_busiest_days",
    """SELECT strftime(metric_date, '%Y-%m-%d') AS metric_date, CAST(total_volume AS DOUBLE) AS total_volume FROM daily
       ORDER BY total_volume DESC, metric_date LIMIT 5""",
)
def m05f(t):
    r = ask("daily_financial_metrics", build.daily(t), ["total_volume"], ["metric_date"],
            order=[F.desc("total_volume"), F.asc("metric_date")], limit=5)
    return build.days(build.doubles(r, "total_volume"), "metric_date")


@query(
    "m05_low_credit_customers",
    "SELECT COUNT(*) AS customer_count FROM c360 WHERE credit_score < 500",
)
def m05g(t):
    return ask("customer_360", build.c360(t), ["customer_count"], where="credit_score < 500")


@query(
    "m05_flagged_on_day",
    "SELECT CAST(SUM(flagged_count) AS BIGINT) AS flagged_count FROM daily WHERE metric_date = DATE '1998-06-01'",
)
def m05h(t):
    return ask("daily_financial_metrics", build.daily(t), ["flagged_count"], where="metric_date = DATE '1998-06-01'")
