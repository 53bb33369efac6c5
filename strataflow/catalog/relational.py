"""Projections, filters and joins (P, J, L)."""

from pyspark.sql import functions as F

from ..functions.compat import dbl_avg, dbl_sum
from ..operators.joins import broadcast_groups, exists_in, left_aggregate, missing_from
from ..operators.windows import top_n_per_group
from .registry import query



@query(
    "p01_projection_alias",
    "SELECT account_id AS acct, account_type AS kind, CAST(balance AS DOUBLE) AS balance FROM accounts",
)
def p01(t):
    return t.accounts().select(
        F.col("account_id").alias("acct"), F.col("account_type").alias("kind"), F.col("balance").cast("double")
    )


@query(
    "p02_derived_columns",
    """SELECT account_id, CAST(balance AS DOUBLE) AS balance, CAST(balance - credit_limit AS DOUBLE) AS net,
              status = 'ACTIVE' AS is_active FROM accounts""",
)
def p02(t):
    return (
        t.accounts()
        .withColumns({"net": F.col("balance") - F.col("credit_limit"), "is_active": F.col("status") == "ACTIVE"})
        .select("account_id", F.col("balance").cast("double"), F.col("net").cast("double").alias("net"), "is_active")
    )


@query(
    "p03_comparison_filters",
    """SELECT account_id, txn_id, CAST(amount AS DOUBLE) AS amount FROM transactions
       WHERE txn_date >= TIMESTAMP '1998-01-01' AND amount > 50000 AND txn_type = 'CREDIT'""",
)
def p03(t):
    return (
        t.transactions()
        .where((F.col("txn_date") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("amount") > 50000))
        .where(F.col("txn_type") == "CREDIT")
        .select("account_id", "txn_id", F.col("amount").cast("double").alias("amount"))
    )


@query(
    "p04_in_list",
    "SELECT ticket_id, resolution_status FROM tickets WHERE resolution_status IN ('OPEN', 'IN_PROGRESS')",
)
def p04(t):
    return (
        t.tickets().where(F.col("resolution_status").isin("OPEN", "IN_PROGRESS")).select("ticket_id", "resolution_status")
    )


@query(
    "p05_null_tests",
    """SELECT CAST(COUNT(*) FILTER (WHERE latest_risk_score IS NULL) AS BIGINT) AS unscored,
              CAST(COUNT(*) FILTER (WHERE latest_risk_score IS NOT NULL) AS BIGINT) AS scored FROM profile""",
)
def p05(t):
    from ..plans.curated import customer_profile

    p = customer_profile(t.customers(), t.accounts(), t.risk_assessments())
    return p.agg(
        F.count_if(F.col("latest_risk_score").isNull()).alias("unscored"),
        F.count_if(F.col("latest_risk_score").isNotNull()).alias("scored"),
    )


@query(
    "p06_like_wildcards",
    "SELECT customer_id, email FROM customers WHERE email NOT LIKE '%_@_%.__%' OR email LIKE '%____1@%'",
)
def p06(t):
    e = F.col("email")
    return t.customers().where(~e.like("%_@_%.__%") | e.like("%____1@%")).select("customer_id", "email")


@query("p07_ilike", "SELECT DISTINCT category FROM transactions WHERE category ILIKE '%o%'")
def p07(t):
    return t.categorised_transactions().where(F.col("category").ilike("%o%")).select("category").distinct()


@query(
    "p08_searched_case",
    """SELECT txn_type, CASE WHEN amount >= 60000 THEN 'LARGE' WHEN amount >= 20000 THEN 'MIDDLE' ELSE 'SMALL' END
              AS size_class, COUNT(*) AS n FROM transactions GROUP BY 1, 2""",
)
def p08(t):
    from ..functions.scoring import bucketize

    size = bucketize("amount", [(60000, "LARGE"), (20000, "MIDDLE")], "SMALL")
    return t.plain_transactions().groupBy("txn_type", size.alias("size_class")).agg(F.count("*").alias("n"))


@query(
    "p09_boolean_condition",
    "SELECT account_id, txn_id, line_number, part_id FROM transactions WHERE is_flagged",
)
def p09(t):
    return t.plain_transactions().where("is_flagged").select("account_id", "txn_id", "line_number", "part_id")


@query(
    "p10_coalesce_defaults",
    """SELECT customer_id, COALESCE(latest_risk_score, 50) AS risk_score,
              COALESCE(debt_to_income, 0.5) AS debt_to_income FROM profile""",
)
def p10(t):
    from ..plans.curated import customer_profile

    p = customer_profile(t.customers(), t.accounts(), t.risk_assessments())
    return p.select(
        "customer_id",
        F.coalesce("latest_risk_score", F.lit(50)).alias("risk_score"),
        F.coalesce("debt_to_income", F.lit(0.5)).alias("debt_to_income"),
    )


@query(
    "p11_guarded_division",
    """SELECT market_data_id, ROUND((close_price - open_price) / NULLIF(open_price, 0) * 100, 6) AS return_pct,
              close_price / NULLIF(volume, 0) AS price_per_unit FROM market_data""",
)
def p11(t):
    from ..plans.curated import market_parsed

    m = market_parsed(t.market_data())
    return m.select(
        "market_data_id",
        F.round((F.col("close_price") - F.col("open_price")) / F.nullif("open_price", F.lit(0.0)) * 100, 6).alias(
            "return_pct"
        ),
        F.try_divide("close_price", "volume").alias("price_per_unit"),
    )


@query(
    "p12_relative_dates",
    """SELECT account_id, txn_id, part_id FROM transactions
       WHERE txn_date >= TIMESTAMP '2001-06-30' - INTERVAL 30 DAY AND txn_date < TIMESTAMP '2001-06-30'""",
)
def p12(t):
    from ..functions.compat import date_add_unit

    as_of = F.lit("2001-06-30").cast("timestamp_ntz")
    d = F.col("txn_date")
    return (
        t.plain_transactions()
        .where((d >= date_add_unit("day", -30, as_of)) & (d < as_of))
        .select("account_id", "txn_id", "part_id")
    )


@query(
    "p13_json_path_filter",
    "SELECT assessment_id, risk_score FROM risk_assessments WHERE risk_score > 75 AND credit_history = 'POOR'",
)
def p13(t):
    from ..functions.compat import json_get

    r = t.risk_assessments().withColumn("risk_data", F.parse_json("risk_data_raw"))
    score = json_get("risk_data", "$.risk_score", "int")
    return r.where((score > 75) & (json_get("risk_data", "$.credit_history", "string") == "POOR")).select(
        "assessment_id", score.alias("risk_score")
    )


@query(
    "p14_boolean_logic",
    """SELECT ticket_id FROM tickets WHERE (priority IN ('HIGH', 'CRITICAL') AND NOT resolution_status = 'CLOSED')
       OR (assigned_to = 'Fraud Team' AND resolution_status = 'OPEN')""",
)
def p14(t):
    urgent = F.col("priority").isin("HIGH", "CRITICAL") & ~(F.col("resolution_status") == "CLOSED")
    fraud = (F.col("assigned_to") == "Fraud Team") & (F.col("resolution_status") == "OPEN")
    return t.tickets().where(urgent | fraud).select("ticket_id")


@query(
    "p15_exists_not_exists",
    """SELECT customer_id, 'has_ticket' AS side FROM customers c
       WHERE EXISTS (SELECT 1 FROM tickets x WHERE x.customer_id = c.customer_id AND x.priority = 'CRITICAL')
       UNION ALL SELECT customer_id, 'no_ticket' FROM customers c
       WHERE NOT EXISTS (SELECT 1 FROM tickets x WHERE x.customer_id = c.customer_id AND x.priority = 'CRITICAL')""",
)
def p15(t):
    c = t.customers().select("customer_id")
    critical = t.tickets().where(F.col("priority") == "CRITICAL")
    return (
        exists_in(c, critical, ["customer_id"])
        .withColumn("side", F.lit("has_ticket"))
        .unionByName(missing_from(c, critical, ["customer_id"]).withColumn("side", F.lit("no_ticket")))
    )


@query(
    "p16_literal_column",
    "SELECT 'transactions' AS section, 'flagged' AS check_name, COUNT(*) AS n FROM transactions WHERE is_flagged",
)
def p16(t):
    return (
        t.plain_transactions()
        .where("is_flagged")
        .agg(F.count("*").alias("n"))
        .select(F.lit("transactions").alias("section"), F.lit("flagged").alias("check_name"), "n")
    )


@query(
    "j01_inner_chain",
    """SELECT customer_country AS country, account_type, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS volume
       FROM enriched GROUP BY customer_country, account_type""",
)
def j01(t):
    x = t.plain_transactions().join(t.accounts(), "account_id").join(t.customers(), "customer_id")
    return x.groupBy("country", "account_type").agg(F.count("*").alias("n"), dbl_sum("amount").alias("volume"))


@query(
    "j02_left_outer",
    """SELECT c.customer_id, x.ticket_id FROM customers c
       LEFT JOIN tickets x ON c.customer_id = x.customer_id AND x.priority = 'CRITICAL'""",
)
def j02(t):
    critical = t.tickets().where(F.col("priority") == "CRITICAL").select("customer_id", "ticket_id")
    return t.customers().select("customer_id").join(critical, "customer_id", "left")


@query(
    "j03_left_join_aggregate",
    """SELECT c.customer_id, COALESCE(x.n, 0) AS n_tickets FROM customers c LEFT JOIN
       (SELECT customer_id, COUNT(*) AS n FROM tickets GROUP BY customer_id) x ON c.customer_id = x.customer_id""",
)
def j03(t):
    return left_aggregate(
        t.customers().select("customer_id"),
        t.tickets(),
        "customer_id",
        [F.count("*").alias("n_tickets")],
        {"n_tickets": 0},
    )


@query(
    "j04_left_join_latest",
    """SELECT c.customer_id, r.risk_score FROM customers c LEFT JOIN
       (SELECT * FROM risk_assessments QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id
        ORDER BY assessed_at DESC, assessment_id DESC) = 1) r ON c.customer_id = r.customer_id""",
)
def j04(t):
    from ..plans.curated import risk_parsed

    latest = top_n_per_group(
        risk_parsed(t.risk_assessments()),
        ["customer_id"],
        [F.desc_nulls_last("assessed_at"), F.desc("assessment_id")],
    )
    return t.customers().select("customer_id").join(latest.select("customer_id", "risk_score"), "customer_id", "left")


@query(
    "j05_using_join",
    "SELECT account_id, customer_id, country, branch_code FROM accounts JOIN customers USING (customer_id)",
)
def j05(t):
    return t.accounts().join(t.customers(), "customer_id").select("account_id", "customer_id", "country", "branch_code")


@query(
    "j06_anti_join_orphans",
    """SELECT a.account_id FROM accounts a LEFT JOIN
       (SELECT DISTINCT account_id FROM transactions WHERE is_flagged) f ON a.account_id = f.account_id
       WHERE f.account_id IS NULL""",
)
def j06(t):
    return missing_from(t.accounts().select("account_id"), t.plain_transactions().where("is_flagged"), ["account_id"])


@query(
    "j07_composite_key",
    """SELECT a.conv_id, a.turn, a.role, b.role AS next_role FROM conversations a JOIN conversations b
       ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn""",
)
def j07(t):
    a = t.raw("conversations").select("conv_id", "turn", "role")
    b = a.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next_role"))
    return a.join(b, ["conv_id", "turn"])


@query(
    "j10_one_row_frames",
    """SELECT (SELECT COUNT(*) FROM customers) AS n_customers,
              (SELECT CAST(SUM(balance) AS DOUBLE) FROM accounts) AS total_balance,
              (SELECT COUNT(*) FROM tickets) AS n_tickets""",
)
def j10(t):
    from ..operators.reshape import combine_single_rows

    return combine_single_rows(
        [
            t.customers().agg(F.count("*").alias("n_customers")),
            t.accounts().agg(dbl_sum("balance").alias("total_balance")),
            t.tickets().agg(F.count("*").alias("n_tickets")),
        ]
    )


@query(
    "j12_lateral_flatten",
    """SELECT assessment_id, pos AS factor_index, risk_factor, factor_score FROM risk_factors
       WHERE risk_factor IS NOT NULL""",
)
def j12(t):
    return t.spark.sql(
        """SELECT assessment_id, CAST(f.pos AS INT) AS factor_index,
                  variant_get(f.value, '$.factor', 'string') AS risk_factor,
                  variant_get(f.value, '$.score', 'int') AS factor_score
           FROM {risk} r, LATERAL variant_explode(try_variant_get(parse_json(r.risk_data_raw), '$.risk_factors', 'variant')) f""",
        risk=t.risk_assessments(),
    )


@query(
    "j14_group_statistics_join",
    """SELECT t.account_id, t.txn_id, t.part_id, t.supplier_id, t.line_number, CAST(t.amount AS DOUBLE) AS amount,
              CAST(t.amount AS DOUBLE) - s.mean AS above_mean
       FROM transactions t JOIN (SELECT category, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS mean
       FROM transactions GROUP BY category) s ON t.category = s.category""",
)
def j14(t):
    x = t.categorised_transactions()
    stats = x.groupBy("category").agg(dbl_avg("amount").alias("mean"))
    amount = F.col("amount").cast("double")
    return x.join(broadcast_groups(stats), "category").select(
        "account_id", "txn_id", "part_id", "supplier_id", "line_number", amount.alias("amount"),
        (amount - F.col("mean")).alias("above_mean"),
    )


@query(
    "j15_correlated_scalar",
    """SELECT ticket_id, (SELECT COUNT(*) FROM accounts a WHERE a.customer_id = t.customer_id) AS customer_accounts,
              (SELECT CAST(SUM(balance) AS DOUBLE) FROM accounts a WHERE a.customer_id = t.customer_id)
              AS customer_balance FROM tickets t""",
)
def j15(t):
    return left_aggregate(
        t.tickets().select("ticket_id", "customer_id"),
        t.accounts(),
        "customer_id",
        [F.count("*").alias("customer_accounts"), dbl_sum("balance").alias("customer_balance")],
        {"customer_accounts": 0},
    ).drop("customer_id")


@query(
    "j16_uncorrelated_scalars",
    """SELECT channel, COUNT(*) AS n, COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM transactions) AS share
       FROM transactions GROUP BY channel""",
)
def j16(t):
    x = t.plain_transactions()
    total = x.agg(F.count("*").alias("n")).scalar()
    return (
        x.groupBy("channel")
        .agg(F.count("*").alias("n"))
        .select("channel", "n", (F.col("n") * F.lit(100.0) / total).alias("share"))
    )


@query(
    "j17_business_key_lookup",
    """SELECT e.email, a.account_type, a.account_id FROM (SELECT email, customer_id FROM customers) e
       JOIN accounts a ON a.customer_id = e.customer_id WHERE e.email LIKE '%@building.com'
       AND a.account_type = '2-HIGH'""",
)
def j17(t):
    who = t.customers().where(F.col("email").like("%@building.com")).select("email", "customer_id")
    high = t.accounts().where(F.col("account_type") == "2-HIGH")
    return who.join(high, "customer_id").select("email", "account_type", "account_id")


@query(
    "l01_mixed_sort",
    """SELECT account_type, status, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, account_type, status DESC)
       AS pos FROM accounts GROUP BY account_type, status""",
)
def l01(t):
    from ..operators.windows import dense_ids

    g = t.accounts().groupBy("account_type", "status").agg(F.count("*").alias("n"))
    return dense_ids(g, [F.desc("n"), F.asc("account_type"), F.desc("status")], "pos")


@query(
    "l02_nulls_last",
    """SELECT customer_id, latest_risk_score FROM profile
       ORDER BY latest_risk_score ASC NULLS LAST, customer_id""",
)
def l02(t):
    from ..plans.curated import customer_profile

    p = customer_profile(t.customers(), t.accounts(), t.risk_assessments())
    return p.select("customer_id", "latest_risk_score").orderBy(F.asc_nulls_last("latest_risk_score"), "customer_id")


@query(
    "l03_top_k",
    """SELECT account_id, CAST(balance AS DOUBLE) AS balance FROM accounts
       ORDER BY balance DESC, account_id LIMIT 20""",
)
def l03(t):
    a = t.accounts().orderBy(F.desc_nulls_last("balance"), "account_id").limit(20)
    return a.select("account_id", F.col("balance").cast("double").alias("balance"))


@query("l04_repeatable_sample", "SELECT ticket_id, subject FROM tickets ORDER BY ticket_id LIMIT 10")
def l04(t):
    return t.tickets().select("ticket_id", "subject").orderBy("ticket_id").limit(10)


@query("l05_paging", "SELECT ticket_id FROM tickets ORDER BY ticket_id LIMIT 50 OFFSET 100")
def l05(t):
    return t.tickets().select("ticket_id").orderBy("ticket_id").offset(100).limit(50)


@query(
    "l06_filtered_largest",
    """SELECT customer_id, customer_name, risk_tier, latest_risk_score FROM risk_board
       WHERE risk_tier IN ('CRITICAL', 'HIGH') ORDER BY latest_risk_score DESC, customer_id LIMIT 20""",
)
def l06(t):
    from ..plans.consumption import risk_dashboard
    from ..plans.curated import customer_profile

    board = risk_dashboard(customer_profile(t.customers(), t.accounts(), t.risk_assessments()))
    return (
        board.where(F.col("risk_tier").isin("CRITICAL", "HIGH"))
        .orderBy(F.desc_nulls_last("latest_risk_score"), "customer_id")
        .limit(20)
        .select("customer_id", "customer_name", "risk_tier", "latest_risk_score")
    )


@query(
    "l07_top_groups",
    "SELECT country, COUNT(*) AS n FROM customers GROUP BY country ORDER BY n DESC, country LIMIT 15",
)
def l07(t):
    return (
        t.customers().groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(15)
    )
