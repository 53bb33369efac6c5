"""Aggregations and reshaping (A, U)."""

from pyspark.sql import functions as F

from ..functions.compat import date_diff, dbl_avg, dbl_sum, flag_count, json_get, percent
from ..operators import reshape
from ..operators.distinct import count_distinct_each
from ..operators.quantiles import group_percentiles
from ..plans import curated
from ..sources.tables import CHANNELS
from . import build
from .registry import query


@query(
    "a01_counts",
    """SELECT COUNT(*) AS n_rows, COUNT(latest_risk_score) AS n_scored FROM profile""",
)
def a01(t):
    return build.profile(t).agg(
        F.count("*").alias("n_rows"), F.count("latest_risk_score").alias("n_scored")
    )


@query(
    "a02_multi_distinct",
    """SELECT txn_type, COUNT(DISTINCT account_id) AS accounts, COUNT(DISTINCT merchant_name) AS merchants,
              COUNT(DISTINCT category) AS categories FROM transactions GROUP BY txn_type""",
)
def a02(t):
    x = t.transactions().select("txn_type", "account_id", "merchant_name", "category")
    n = count_distinct_each(x, ["txn_type"], ["account_id", "merchant_name"], {"category": build.categories(t)})
    return n.select(
        "txn_type", F.col("n_account_id").alias("accounts"), F.col("n_merchant_name").alias("merchants"), F.col("n_category").alias("categories")
    )


@query(
    "a03_basic_measures",
    """SELECT channel, CAST(SUM(amount) AS DOUBLE) AS volume, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean,
              CAST(MIN(amount) AS DOUBLE) AS low, CAST(MAX(amount) AS DOUBLE) AS high FROM transactions GROUP BY channel""",
)
def a03(t):
    return t.plain_transactions().groupBy("channel").agg(
        dbl_sum("amount").alias("volume"),
        dbl_avg("amount").alias("mean"),
        F.min("amount").cast("double").alias("low"),
        F.max("amount").cast("double").alias("high"),
    )


@query(
    "a04_conditional_sum",
    """SELECT account_id, CAST(SUM(CASE WHEN txn_type = 'DEBIT' THEN amount ELSE 0 END) AS DOUBLE) AS debits,
              CAST(SUM(CASE WHEN txn_type = 'CREDIT' THEN amount ELSE 0 END) AS DOUBLE) AS credits
       FROM transactions GROUP BY account_id""",
)
def a04(t):
    def side(kind):
        return F.sum(F.when(F.col("txn_type") == kind, F.col("amount")).otherwise(0)).cast("double")

    return t.plain_transactions().groupBy("account_id").agg(
        side("DEBIT").alias("debits"), side("CREDIT").alias("credits")
    )


@query(
    "a05_count_if",
    """SELECT CAST(COUNT_IF(credit_score < 400 OR credit_score > 800) AS BIGINT) AS out_of_range,
              CAST(COUNT_IF(annual_income < 0) AS BIGINT) AS negative_income FROM customers""",
)
def a05(t):
    return t.customers().agg(
        F.count_if((F.col("credit_score") < 400) | (F.col("credit_score") > 800)).alias("out_of_range"),
        F.count_if(F.col("annual_income") < 0).alias("negative_income"),
    )


@query(
    "a06_distinct_case",
    """SELECT COUNT(DISTINCT CASE WHEN is_flagged THEN account_id END) AS flagged_accounts,
              COUNT(DISTINCT CASE WHEN txn_type = 'CREDIT' THEN supplier_id END) AS credit_suppliers
       FROM transactions""",
)
def a06(t):
    return t.plain_transactions().agg(
        F.countDistinct(F.when(F.col("is_flagged"), F.col("account_id"))).alias("flagged_accounts"),
        F.countDistinct(F.when(F.col("txn_type") == "CREDIT", F.col("supplier_id"))).alias("credit_suppliers"),
    )


@query(
    "a07_flag_rate",
    """SELECT channel, ROUND(CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / COUNT(*), 2)
       AS flag_rate FROM transactions GROUP BY channel""",
)
def a07(t):
    return t.plain_transactions().groupBy("channel").agg(
        percent(flag_count(F.col("is_flagged")), F.count("*")).alias("flag_rate")
    )


@query(
    "a08_range",
    """SELECT category, CAST(MAX(amount) - MIN(amount) AS DOUBLE) AS amount_range FROM transactions GROUP BY category""",
)
def a08(t):
    return t.categorised_transactions().groupBy("category").agg(
        (F.max("amount") - F.min("amount")).cast("double").alias("amount_range")
    )


@query(
    "a09_stddev_samp",
    """SELECT account_id, ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 4) AS sd FROM transactions GROUP BY account_id""",
)
def a09(t):
    return t.plain_transactions().groupBy("account_id").agg(
        F.round(F.stddev_samp(F.col("amount").cast("double")), 4).alias("sd")
    )


@query(
    "a10_median",
    """SELECT channel, ROUND(MEDIAN(CAST(amount AS DOUBLE)), 4) AS median_amount FROM transactions GROUP BY channel""",
)
def a10(t):
    m = group_percentiles(t.plain_transactions(), ["channel"], "amount", {"median_amount": 0.5})
    return m.withColumn("median_amount", F.round("median_amount", 4))


@query(
    "a11_percentiles",
    """SELECT category, ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.25), 4) AS p25,
              ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.75), 4) AS p75,
              ROUND(QUANTILE_CONT(CAST(amount AS DOUBLE), 0.95), 4) AS p95 FROM transactions GROUP BY category""",
)
def a11(t):
    p = group_percentiles(
        t.categorised_transactions(), ["category"], "amount", {"p25": 0.25, "p75": 0.75, "p95": 0.95}
    )
    return p.withColumns({c: F.round(c, 4) for c in ("p25", "p75", "p95")})


@query(
    "a12_group_by_expression",
    """SELECT strftime(date_trunc('month', txn_date), '%Y-%m-%d') AS txn_month, COUNT(*) AS n,
              CAST(SUM(amount) AS DOUBLE) AS volume FROM transactions GROUP BY 1""",
)
def a12(t):
    month = F.date_format(F.trunc(F.to_date("txn_date"), "month"), "yyyy-MM-dd").alias("txn_month")
    return t.plain_transactions().groupBy(month).agg(F.count("*").alias("n"), dbl_sum("amount").alias("volume"))


@query(
    "a13_group_by_json_path",
    "SELECT credit_history, COUNT(*) AS n, MAX(risk_score) AS top_score FROM risk_assessments GROUP BY credit_history",
)
def a13(t):
    data = F.parse_json("risk_data_raw")
    typed = t.risk_assessments().select(
        json_get(data, "$.credit_history", "string").alias("credit_history"),
        json_get(data, "$.risk_score", "int").alias("risk_score"),
    )
    return typed.groupBy("credit_history").agg(F.count("*").alias("n"), F.max("risk_score").alias("top_score"))


@query(
    "a14_many_keys",
    """SELECT doc_type, regulatory_body, doc_status, classification, review_cycle, COUNT(*) AS n
       FROM compliance GROUP BY ALL""",
)
def a14(t):
    docs = curated.compliance_enriched(t.compliance_documents())
    return docs.groupBy("doc_type", "regulatory_body", "doc_status", "classification", "review_cycle").agg(
        F.count("*").alias("n")
    )


ROLLUP_SQL = f"""SELECT resolution_status, priority, CAST(GROUPING_ID(resolution_status, priority) AS INTEGER) AS level,
       COUNT(*) AS ticket_count,
       CAST(SUM(DATE_DIFF('hour', created_at, TIMESTAMP '{build.AS_OF_TICKETS}')) AS DOUBLE) / COUNT(*) AS avg_age_hours,
       strftime(MIN(created_at), '%Y-%m-%d %H:%M:%S') AS oldest_ticket,
       strftime(MAX(created_at), '%Y-%m-%d %H:%M:%S') AS newest_ticket
       FROM tickets GROUP BY ROLLUP (resolution_status, priority)"""


def ticket_funnel(t):
    age = date_diff("hour", "created_at", F.lit(build.AS_OF_TICKETS).cast("timestamp_ntz"))
    g = t.tickets().rollup("resolution_status", "priority").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count("*").alias("ticket_count"),
        dbl_avg(age).alias("avg_age_hours"),
        F.min("created_at").alias("oldest_ticket"),
        F.max("created_at").alias("newest_ticket"),
    )
    return build.texts(g, "oldest_ticket", "newest_ticket").orderBy(
        F.asc_nulls_last("resolution_status"), F.asc_nulls_last("priority")
    )


@query("a15_rollup", ROLLUP_SQL)
def a15(t):
    return ticket_funnel(t)


@query(
    "a16_cube_grouping_sets",
    """SELECT 'cube' AS kind, txn_type, channel, COUNT(*) AS n FROM transactions GROUP BY CUBE (txn_type, channel)
       UNION ALL SELECT 'sets', txn_type, channel, COUNT(*) FROM transactions
       GROUP BY GROUPING SETS ((txn_type), (channel), ())""",
)
def a16(t):
    x = t.plain_transactions().select("txn_type", "channel")
    cube = x.cube("txn_type", "channel").agg(F.count("*").alias("n")).withColumn("kind", F.lit("cube"))
    sets = x.groupingSets([["txn_type"], ["channel"], []], "txn_type", "channel").agg(F.count("*").alias("n"))
    return cube.unionByName(sets.withColumn("kind", F.lit("sets")))


@query(
    "a17_global_aggregate",
    """SELECT COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS volume, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean
       FROM enriched""",
)
def a17(t):
    return build.plain_enriched(t).agg(
        F.count("*").alias("n"), dbl_sum("amount").alias("volume"), dbl_avg("amount").alias("mean")
    )


@query(
    "a18_aggregate_of_aggregates",
    """SELECT strftime(date_trunc('month', d), '%Y-%m-%d') AS revenue_month, CAST(SUM(n) AS BIGINT) AS monthly_transactions,
              MAX(n) AS busiest_day FROM (SELECT CAST(txn_date AS DATE) AS d, COUNT(*) AS n FROM transactions GROUP BY 1)
       GROUP BY 1""",
)
def a18(t):
    day = t.plain_transactions().groupBy(F.to_date("txn_date").alias("d")).agg(F.count("*").alias("n"))
    g = day.groupBy(F.trunc("d", "month").alias("revenue_month")).agg(
        F.sum("n").alias("monthly_transactions"), F.max("n").alias("busiest_day")
    )
    return build.days(g, "revenue_month")


@query(
    "a19_days_since_last",
    """SELECT account_id, DATE_DIFF('day', CAST(MAX(txn_date) AS DATE), DATE '2001-12-31') AS idle_days
       FROM transactions GROUP BY account_id""",
)
def a19(t):
    return t.plain_transactions().groupBy("account_id").agg(
        date_diff("day", F.max("txn_date"), build.as_of()).alias("idle_days")
    )


@query(
    "a20_average_age",
    f"""SELECT assigned_to, CAST(SUM(DATE_DIFF('hour', created_at, TIMESTAMP '{build.AS_OF_TICKETS}')) AS DOUBLE)
        / COUNT(*) AS avg_age_hours FROM tickets GROUP BY assigned_to""",
)
def a20(t):
    age = date_diff("hour", "created_at", F.lit(build.AS_OF_TICKETS).cast("timestamp_ntz"))
    return t.tickets().groupBy("assigned_to").agg(dbl_avg(age).alias("avg_age_hours"))


@query("a21_value_counts", "SELECT employment_status, COUNT(*) AS n FROM customers GROUP BY employment_status")
def a21(t):
    return reshape.value_counts(t.customers(), "employment_status")


@query(
    "a22_multi_measure_group",
    """SELECT channel, CAST(SUM(transaction_count) AS BIGINT) AS transactions, CAST(SUM(total_volume) AS DOUBLE) AS volume,
              ROUND(AVG(avg_amount), 4) AS avg_amount, CAST(SUM(flagged_count) AS BIGINT) AS flagged
       FROM channel_daily GROUP BY channel""",
)
def a22(t):
    return build.channel_daily(t).groupBy("channel").agg(
        F.sum("transaction_count").alias("transactions"),
        dbl_sum("total_volume").alias("volume"),
        F.round(F.avg("avg_amount"), 4).alias("avg_amount"),
        F.sum("flagged_count").alias("flagged"),
    )


@query(
    "a23_label_mean",
    "SELECT AVG(CAST(quality AS DOUBLE)) AS quality_rate, AVG(CAST(toxic AS DOUBLE)) AS toxic_rate FROM labels",
)
def a23(t):
    return t.raw("labels").agg(F.avg("quality").alias("quality_rate"), F.avg("toxic").alias("toxic_rate"))


@query(
    "a24_filter_on_aggregate",
    """SELECT account_id, COUNT(*) AS n, CAST(SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) AS BIGINT) AS flagged
       FROM transactions GROUP BY account_id HAVING SUM(CASE WHEN is_flagged THEN 1 ELSE 0 END) >= 2""",
)
def a24(t):
    g = t.plain_transactions().groupBy("account_id").agg(
        F.count("*").alias("n"), flag_count(F.col("is_flagged")).alias("flagged")
    )
    return g.where(F.col("flagged") >= 2)


@query(
    "a25_batch_arrivals",
    """SELECT event_id // 200 AS batch_id, COUNT(*) AS n_rows, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_arrival,
              strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_arrival,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
              CAST(COUNT_IF(event_type = 'error') AS BIGINT) AS flagged FROM events GROUP BY 1""",
)
def a25(t):
    e = t.raw("events").withColumn("batch_id", F.floor(F.col("event_id") / 200).cast("long"))
    g = e.groupBy("batch_id").agg(
        F.count("*").alias("n_rows"),
        F.min("ts").alias("first_arrival"),
        F.max("ts").alias("last_arrival"),
        dbl_sum(F.col("value").cast("decimal(18,2)")).alias("total"),
        F.count_if(F.col("event_type") == "error").alias("flagged"),
    )
    return build.texts(g, "first_arrival", "last_arrival")


COUNT_TABLES = ("customers", "accounts", "transactions", "tickets", "risk_assessments", "market_data", "compliance")
COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}" for n in COUNT_TABLES
)


def base_tables(t):
    return {
        "customers": t.customers(),
        "accounts": t.accounts(),
        "transactions": t.plain_transactions(),
        "tickets": t.tickets(),
        "risk_assessments": t.risk_assessments(),
        "market_data": t.market_data(),
        "compliance": t.compliance_documents(),
    }


@query("u01_labelled_counts", COUNTS_SQL)
def u01(t):
    return reshape.labelled_counts(base_tables(t))


@query(
    "u02_union_of_builders",
    """SELECT account_id, 'urgent' AS source, CAST(balance AS DOUBLE) AS amount FROM accounts
       WHERE account_type = '1-URGENT' UNION ALL
       SELECT account_id, 'flagged', CAST(amount AS DOUBLE) FROM transactions WHERE is_flagged""",
)
def u02(t):
    a = t.accounts().where(F.col("account_type") == "1-URGENT")
    x = t.plain_transactions().where("is_flagged")
    return reshape.union_all(
        [
            a.select("account_id", F.lit("urgent").alias("source"), F.col("balance").cast("double").alias("amount")),
            x.select("account_id", F.lit("flagged").alias("source"), F.col("amount").cast("double").alias("amount")),
        ]
    )


@query(
    "u03_pivot_channel_month",
    "SELECT strftime(date_trunc('month', txn_date), '%Y-%m-%d') AS txn_month, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN channel = '{c}' THEN amount END) AS DOUBLE) AS {c.lower()}_volume" for c in CHANNELS
    )
    + " FROM transactions WHERE txn_date >= TIMESTAMP '1997-01-01' GROUP BY 1",
)
def u03(t):
    x = (
        t.plain_transactions()
        .where(F.col("txn_date") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        .withColumn("txn_month", F.trunc(F.to_date("txn_date"), "month"))
    )
    p = reshape.pivot_sum(x, ["txn_month"], "channel", CHANNELS, F.col("amount"))
    return build.days(p, "txn_month").select(
        "txn_month", *[F.col(c).cast("double").alias(f"{c.lower()}_volume") for c in CHANNELS]
    )


@query(
    "u04_unpivot_balances",
    """SELECT account_id, metric, value FROM (
         SELECT account_id, 'current_balance' AS metric, CAST(balance AS DOUBLE) AS value FROM accounts
         WHERE account_type = '1-URGENT' UNION ALL
         SELECT account_id, 'over_limit', CAST(CASE WHEN balance > credit_limit / 2 THEN balance - credit_limit / 2 END AS DOUBLE)
         FROM accounts WHERE account_type = '1-URGENT') WHERE value IS NOT NULL""",
)
def u04(t):
    half = F.col("credit_limit") / 2
    a = (
        t.accounts()
        .where(F.col("account_type") == "1-URGENT")
        .select(
            "account_id",
            F.col("balance").cast("double").alias("current_balance"),
            F.when(F.col("balance") > half, F.col("balance") - half).cast("double").alias("over_limit"),
        )
    )
    return reshape.unpivot_values(a, ["account_id"], ["current_balance", "over_limit"])


@query(
    "u05_melt_measures",
    """SELECT txn_type, metric, value FROM (SELECT txn_type, CAST(SUM(amount) AS DOUBLE) AS volume,
              CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean, CAST(MAX(amount) AS DOUBLE) AS peak
       FROM transactions GROUP BY txn_type) UNPIVOT (value FOR metric IN (volume, mean, peak))""",
)
def u05(t):
    g = t.plain_transactions().groupBy("txn_type").agg(
        dbl_sum("amount").alias("volume"),
        dbl_avg("amount").alias("mean"),
        F.max("amount").cast("double").alias("peak"),
    )
    return reshape.unpivot_values(g, ["txn_type"], ["volume", "mean", "peak"])


@query(
    "u06_flatten_index_value",
    """SELECT assessment_id, pos AS factor_index, risk_factor, factor_score FROM risk_factors""",
)
def u06(t):
    flat = reshape.flatten(
        curated.risk_parsed(t.risk_assessments()), F.col("risk_factors"), "factor_index", "factor", outer=True
    )
    return flat.select(
        "assessment_id",
        "factor_index",
        F.col("factor.factor").alias("risk_factor"),
        F.col("factor.score").alias("factor_score"),
    )


@query(
    "u07_cte_composition",
    """WITH spend AS (SELECT customer_id, SUM(amount) AS total FROM enriched WHERE txn_type = 'DEBIT' GROUP BY customer_id),
            big AS (SELECT * FROM spend WHERE total > 500000)
       SELECT country, COUNT(*) AS n, CAST(SUM(total) AS DOUBLE) AS volume
       FROM big JOIN customers ON big.customer_id = customers.customer_id GROUP BY country""",
)
def u07(t):
    spend = (
        build.plain_enriched(t).where(F.col("txn_type") == "DEBIT").groupBy("customer_id").agg(F.sum("amount").alias("total"))
    )
    big = spend.where(F.col("total") > 500000)
    return (
        big.join(t.customers(), "customer_id")
        .groupBy("country")
        .agg(F.count("*").alias("n"), dbl_sum("total").alias("volume"))
    )


@query(
    "u08_array_membership",
    """SELECT assessment_id FROM risk_factors WHERE risk_factor IN ('payment_history', 'public_records')
       GROUP BY assessment_id""",
)
def u08(t):
    names = F.transform("risk_factors", lambda f: f["factor"])
    wanted = F.array(F.lit("payment_history"), F.lit("public_records"))
    return (
        curated.risk_parsed(t.risk_assessments())
        .where(F.size(F.array_intersect(names, wanted)) > 0)
        .select("assessment_id")
    )
