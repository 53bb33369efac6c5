"""Scalar functions (X) and user-defined functions (F)."""

from pyspark.sql import functions as F

from ..functions import scoring, vectors
from ..functions.compat import date_add_unit, date_diff, json_get, ratio_or_zero
from ..functions.factors import parse_risk_factors, register_table_function
from ..plans import consumption, curated
from . import build
from .registry import query


@query("x01_concat", "SELECT account_id, branch_code || ' ' || account_type AS label FROM accounts")
def x01(t):
    return t.accounts().select("account_id", F.concat("branch_code", F.lit(" "), "account_type").alias("label"))


@query("x02_lower", "SELECT customer_id, lower(customer_name) AS lowered FROM customers")
def x02(t):
    return t.customers().select("customer_id", F.lower("customer_name").alias("lowered"))


@query(
    "x03_lpad",
    "SELECT account_id, lpad(CAST(account_id * 7 % 100 AS VARCHAR), 2, '0') AS tail FROM accounts",
)
def x03(t):
    return t.accounts().select(
        "account_id", F.lpad((F.col("account_id") * 7 % 100).cast("string"), 2, "0").alias("tail")
    )


@query("x04_preview", "SELECT doc_id, left(text, 150) || '...' AS preview FROM documents")
def x04(t):
    return t.raw("documents").select("doc_id", F.concat(F.left("text", F.lit(150)), F.lit("...")).alias("preview"))


@query("x05_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS content_length FROM documents")
def x05(t):
    return t.raw("documents").select("doc_id", F.length("text").alias("content_length"))


@query(
    "x06_casts",
    """SELECT event_id, CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS round_trip,
              TRY_CAST(event_type AS BIGINT) AS bad_number, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
              CAST(k AS DOUBLE) AS k_float, CAST(k % 2 AS BOOLEAN) AS odd FROM ev""",
)
def x06(t):
    k = json_get(F.parse_json("props"), "$.k", "int")
    return t.raw("events").select(
        "event_id",
        F.col("event_id").cast("string").cast("long").alias("round_trip"),
        F.col("event_type").try_cast("long").alias("bad_number"),
        F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd").alias("day"),
        k.cast("double").alias("k_float"),
        (k % 2).cast("boolean").alias("odd"),
    )


@query(
    "x07_number_format",
    """SELECT account_id, format('{:,}', CAST(floor(balance) AS BIGINT)) AS grouped FROM accounts""",
)
def x07(t):
    return t.accounts().select("account_id", F.format_number(F.floor("balance"), 0).alias("grouped"))


@query(
    "x08_sentence_template",
    """SELECT account_id, 'Account ' || CAST(account_id AS VARCHAR) || ' (' || account_type || ') is ' || lower(status)
       || ' at branch ' || branch_code AS sentence FROM accounts""",
)
def x08(t):
    return t.accounts().select(
        "account_id",
        F.format_string(
            "Account %d (%s) is %s at branch %s", "account_id", "account_type", F.lower("status"), "branch_code"
        ).alias("sentence"),
    )


@query(
    "x09_date_diff_units",
    """SELECT ticket_id, DATE_DIFF('day', created_at, TIMESTAMP '2024-02-01 00:30:00') AS days,
              DATE_DIFF('hour', created_at, TIMESTAMP '2024-02-01 00:30:00') AS hours,
              DATE_DIFF('minute', created_at, TIMESTAMP '2024-02-01 00:30:00') AS minutes,
              DATE_DIFF('second', created_at, TIMESTAMP '2024-02-01 00:30:00') AS seconds,
              DATE_DIFF('month', created_at, TIMESTAMP '2024-02-01 00:30:00') AS months FROM tickets""",
)
def x09(t):
    end = F.lit(build.AS_OF_TICKETS).cast("timestamp_ntz")
    units = {"days": "day", "hours": "hour", "minutes": "minute", "seconds": "second", "months": "month"}
    return t.tickets().select("ticket_id", *[date_diff(u, "created_at", end).alias(n) for n, u in units.items()])


@query(
    "x10_date_add_units",
    """SELECT ticket_id, strftime(created_at - INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS month_before,
              strftime(created_at + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S') AS day_after,
              strftime(created_at - INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS earlier FROM tickets""",
)
def x10(t):
    c = F.col("created_at")
    return build.texts(
        t.tickets().select(
            "ticket_id",
            date_add_unit("day", -30, c).alias("month_before"),
            date_add_unit("hour", 24, c).alias("day_after"),
            date_add_unit("minute", -90, c).alias("earlier"),
        ),
        "month_before", "day_after", "earlier",
    )


@query(
    "x11_date_trunc",
    """SELECT account_id, strftime(date_trunc('month', opened_date), '%Y-%m-%d') AS opened_month FROM accounts""",
)
def x11(t):
    return build.days(t.accounts().select("account_id", F.trunc("opened_date", "month").alias("opened_month")), "opened_month")


@query(
    "x12_as_of_parameter",
    "SELECT account_id, DATE_DIFF('day', opened_date, DATE '2001-12-31') AS age_days FROM accounts",
)
def x12(t):
    return t.accounts().select("account_id", date_diff("day", "opened_date", build.as_of()).alias("age_days"))


@query(
    "x13_year_start",
    """SELECT customer_id, CAST(year(date_of_birth) AS INTEGER) AS birth_year,
              strftime(make_date(CAST(year(date_of_birth) AS INTEGER), 1, 1), '%Y-%m-%d') AS year_start FROM customers""",
)
def x13(t):
    y = F.year("date_of_birth")
    return t.customers().select(
        "customer_id", y.alias("birth_year"),
        F.date_format(F.make_date(y, F.lit(1), F.lit(1)), "yyyy-MM-dd").alias("year_start"),
    )


@query(
    "x14_timestamp_text",
    """SELECT ticket_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS as_text,
              epoch(CAST(strftime(created_at, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP))::BIGINT AS parsed_epoch FROM tickets""",
)
def x14(t):
    text = F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")
    return t.tickets().select(
        "ticket_id", text.alias("as_text"),
        F.unix_seconds(F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss")).alias("parsed_epoch"),
    )


@query(
    "x15_round",
    """SELECT account_id, CAST(ROUND(balance, 1) AS DOUBLE) AS balance_1, CAST(ROUND(balance, 0) AS DOUBLE) AS balance_0
       FROM accounts""",
)
def x15(t):
    return t.accounts().select(
        "account_id",
        F.round("balance", 1).cast("double").alias("balance_1"),
        F.round("balance", 0).cast("double").alias("balance_0"),
    )


@query(
    "x16_scalar_min_max",
    """SELECT market_data_id, ABS(macd) AS strength, LEAST(open_price, close_price) AS low_end,
              GREATEST(open_price, close_price) AS high_end FROM market_data""",
)
def x16(t):
    m = curated.market_parsed(t.market_data())
    return m.select(
        "market_data_id", F.abs("macd").alias("strength"), F.least("open_price", "close_price").alias("low_end"),
        F.greatest("open_price", "close_price").alias("high_end"),
    )


@query(
    "x17_clamp",
    "SELECT customer_id, LEAST(700, GREATEST(450, credit_score)) AS clamped FROM customers",
)
def x17(t):
    return t.customers().select(
        "customer_id", F.least(F.lit(700), F.greatest(F.lit(450), "credit_score")).alias("clamped")
    )


@query(
    "x18_mod_power",
    "SELECT account_id, account_id * 13 % 1000 AS tail, POWER(CAST(account_id % 10 AS DOUBLE), 2) AS squared FROM accounts",
)
def x18(t):
    i = F.col("account_id")
    return t.accounts().select("account_id", (i * 13 % 1000).alias("tail"), F.pow((i % 10).cast("double"), F.lit(2.0)).alias("squared"))


@query(
    "x19_array_index",
    """SELECT account_id, CASE account_id % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'east' WHEN 2 THEN 'south' END AS area
       FROM accounts""",
)
def x19(t):
    areas = F.array(F.lit("north"), F.lit("east"), F.lit("south"))
    return t.accounts().select("account_id", F.get(areas, (F.col("account_id") % 4).cast("int")).alias("area"))


@query(
    "x20_array_size",
    "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings",
)
def x20(t):
    return t.raw("embeddings").select("vec_id", F.size("embedding").alias("dims"))


@query(
    "x21_array_intersection",
    """SELECT assessment_id, CAST(COUNT(*) FILTER (WHERE risk_factor IN ('credit_mix', 'new_accounts')) AS INTEGER) AS hits
       FROM risk_factors GROUP BY assessment_id""",
)
def x21(t):
    names = F.transform("risk_factors", lambda f: f["factor"])
    hits = F.size(F.array_intersect(names, F.array(F.lit("credit_mix"), F.lit("new_accounts"))))
    r = curated.risk_parsed(t.risk_assessments())
    return r.select("assessment_id", F.when(F.col("risk_factors").isNull(), F.lit(0)).otherwise(hits).alias("hits"))


@query(
    "x22_transform_lambda",
    """SELECT assessment_id, string_agg(CAST(factor_score * 2 AS VARCHAR), ',' ORDER BY pos) AS doubled
       FROM risk_factors WHERE risk_factor IS NOT NULL GROUP BY assessment_id""",
)
def x22(t):
    doubled = F.transform("risk_factors", lambda f: (f["score"] * 2).cast("string"))
    r = curated.risk_parsed(t.risk_assessments()).where(F.size("risk_factors") > 0)
    return r.select("assessment_id", F.array_join(doubled, ",").alias("doubled"))


@query(
    "x23_object_constructor",
    """SELECT account_id, '{"id":' || CAST(account_id AS VARCHAR) || ',"place":{"branch":"' || branch_code || '"},"kind":"'
       || account_type || '"}' AS doc FROM accounts""",
)
def x23(t):
    doc = F.struct(
        F.col("account_id").alias("id"),
        F.struct(F.col("branch_code").alias("branch")).alias("place"),
        F.col("account_type").alias("kind"),
    )
    return t.accounts().select("account_id", F.to_json(doc).alias("doc"))


@query(
    "x24_parse_json",
    """SELECT event_id, k, CASE WHEN event_id % 3 = 0 THEN NULL ELSE k END AS tolerant FROM ev""",
)
def x24(t):
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return t.raw("events").select(
        "event_id",
        json_get(F.parse_json("props"), "$.k", "int").alias("k"),
        json_get(F.try_parse_json(broken), "$.k", "int", strict=False).alias("tolerant"),
    )


@query(
    "x25_json_paths",
    "SELECT market_data_id, open_price, rsi, macd, volume FROM market_data",
)
def x25(t):
    m = F.parse_json("market_data_raw")
    return t.market_data().select(
        "market_data_id",
        json_get(m, "$.open", "double").alias("open_price"),
        json_get(m, "$.indicators.rsi", "double").alias("rsi"),
        json_get(m, "$['indicators']['macd']", "double").alias("macd"),
        json_get(m, "$.volume", "bigint").alias("volume"),
    )


@query(
    "x26_element_path",
    "SELECT assessment_id, risk_factor AS first_factor, factor_score AS first_score FROM risk_factors WHERE pos = 0",
)
def x26(t):
    d = F.parse_json("risk_data_raw")
    name = json_get(d, "$.risk_factors[0].factor", "string")
    return (
        t.risk_assessments()
        .select("assessment_id", name.alias("first_factor"), json_get(d, "$.risk_factors[0].score", "int").alias("first_score"))
        .where(F.col("first_factor").isNotNull())
    )


@query(
    "x27_subtree_text",
    """SELECT market_data_id, '{"macd":' || CAST(macd AS VARCHAR) || ',"rsi":' || CAST(CAST(k AS INTEGER) AS VARCHAR) || '}' AS inner_text
       FROM (SELECT event_id AS market_data_id, (k - 50) / 10.0::DOUBLE AS macd, k FROM ev) WHERE macd <> round(macd)""",
)
def x27(t):
    d = F.parse_json("market_data_raw")
    macd = json_get(d, "$.indicators.macd", "double")
    # A VARIANT object prints its keys in sorted order.
    part = F.struct(
        macd.alias("macd"), json_get(d, "$.indicators.rsi", "int").alias("rsi")
    )
    return t.market_data().where(macd != F.round(macd)).select(
        "market_data_id", F.to_json(F.to_variant_object(part)).alias("inner_text")
    )


@query(
    "x28_cosine_similarity",
    """SELECT vec_id, ROUND(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 0) AS DOUBLE[])), 6)
       AS similarity FROM embeddings""",
)
def x28(t):
    e = t.raw("embeddings")
    # The query vector is one row, handed over as a literal.
    probe = F.lit([float(x) for x in e.where(F.col("vec_id") == 0).select("embedding").first()[0]])
    return e.select("vec_id", F.round(vectors.cosine(F.col("embedding"), probe), 6).alias("similarity"))


@query(
    "x29_tier_mappings",
    """SELECT market_data_id, CASE WHEN rsi > 70 THEN 'OVERBOUGHT' WHEN rsi < 30 THEN 'OVERSOLD' ELSE 'NEUTRAL' END AS rsi_signal,
              CASE WHEN macd > 0 THEN 'BULLISH' ELSE 'BEARISH' END AS macd_signal,
              CASE WHEN rsi >= 80 THEN 'CRITICAL' WHEN rsi >= 60 THEN 'HIGH' WHEN rsi >= 40 THEN 'MEDIUM'
                   WHEN rsi >= 20 THEN 'LOW' ELSE 'MINIMAL' END AS tier FROM market_data""",
)
def x29(t):
    m = curated.market_parsed(t.market_data())
    return m.select(
        "market_data_id", scoring.rsi_signal("rsi").alias("rsi_signal"), scoring.macd_signal("macd").alias("macd_signal"),
        scoring.dashboard_tier("rsi").alias("tier"),
    )


@query(
    "x32_utilization_ratio",
    """SELECT account_id, CASE WHEN credit_limit > 0 THEN ROUND(CAST(balance AS DOUBLE) / CAST(credit_limit AS DOUBLE), 4)
       ELSE 0.0 END AS utilization FROM accounts""",
)
def x32(t):
    return t.accounts().select("account_id", ratio_or_zero(F.col("balance"), F.col("credit_limit")).alias("utilization"))


@query(
    "x34_positional_template",
    """SELECT ticket_id, 'Ticket about ' || subject || ' has priority ' || priority AS prompt FROM tickets""",
)
def x34(t):
    return t.tickets().select(
        "ticket_id", F.format_string("Ticket about %1$s has priority %2$s", "subject", "priority").alias("prompt")
    )


@query(
    "f01_anomaly_function",
    """SELECT account_id, txn_id, line_number, part_id, supplier_id, CASE WHEN s.sd IS NULL OR s.sd = 0 THEN 0.0
              ELSE LEAST(ROUND(ABS((CAST(amount AS DOUBLE) - m) / s.sd) * 25, 2), 100.0) END AS score
       FROM transactions t JOIN (SELECT category, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS m,
            STDDEV_SAMP(CAST(amount AS DOUBLE)) AS sd FROM transactions GROUP BY category) s ON t.category = s.category""",
)
def f01(t):
    scoring.register_sql_functions(t.spark)
    scored = consumption.with_category_statistics(t.categorised_transactions())
    return scored.select(
        "account_id", "txn_id", "line_number", "part_id", "supplier_id",
        F.expr("anomaly_score(cast(amount as double), avg_amount, stddev_amount)").alias("score"),
    )


@query(
    "f02_risk_tier_sql_function",
    """SELECT assessment_id, CASE WHEN comp >= 70 THEN 'CRITICAL' WHEN comp >= 50 THEN 'HIGH' WHEN comp >= 30 THEN 'MEDIUM'
              WHEN comp >= 15 THEN 'LOW' ELSE 'MINIMAL' END AS tier
       FROM (SELECT assessment_id, risk_score * 0.5::DOUBLE + (850.0::DOUBLE - (300 + risk_score * 5)) / 850 * 30
                    + LEAST(debt_to_income * 20, 20.0::DOUBLE) AS comp FROM risk_assessments)""",
)
def f02(t):
    scoring.register_sql_functions(t.spark)
    r = curated.risk_parsed(t.risk_assessments())
    return r.select(
        "assessment_id",
        F.expr("risk_tier(cast(risk_score as double), cast(300 + risk_score * 5 as double), debt_to_income)").alias("tier"),
    )


PARSED_SQL = """SELECT assessment_id, risk_score, credit_history, COALESCE(risk_factor, 'NONE') AS factor_name, factor_score,
       debt_to_income FROM risk_factors"""


@query("f03_parse_risk_factors", PARSED_SQL)
def f03(t):
    return parse_risk_factors(t.risk_assessments(), "risk_data_raw").select(
        "assessment_id", "risk_score", "credit_history", "factor_name", "factor_score", "debt_to_income"
    )


@query("j13_lateral_table_function", PARSED_SQL)
def j13(t):
    register_table_function(t.spark)
    return t.spark.sql(
        """SELECT r.assessment_id, f.risk_score, f.credit_history, f.factor_name, f.factor_score, f.debt_to_income
           FROM {risk} r, LATERAL parse_risk_factors(r.risk_data_raw) f""",
        risk=t.risk_assessments(),
    )


@query(
    "f07_higher_order_lambda",
    "SELECT assessment_id, CAST(MAX(factor_score) AS INTEGER) AS top_score FROM risk_factors WHERE factor_score IS NOT NULL GROUP BY assessment_id",
)
def f07(t):
    r = curated.risk_parsed(t.risk_assessments()).where(F.size("risk_factors") > 0)
    return r.select("assessment_id", F.array_max(F.transform("risk_factors", lambda f: f["score"])).alias("top_score"))


@query(
    "f08_customer_narrative",
    """SELECT customer_id, customer_name || ' from ' || country || ' is a ' || customer_segment || ' customer with '
       || CAST(total_accounts AS VARCHAR) || ' accounts, ' || CAST(total_transactions AS VARCHAR) || ' transactions and '
       || CAST(total_tickets AS VARCHAR) || ' tickets.' AS narrative FROM c360""",
)
def f08(t):
    return build.c360(t).select(
        "customer_id",
        F.format_string(
            "%s from %s is a %s customer with %d accounts, %d transactions and %d tickets.",
            "customer_name", "country", "customer_segment", "total_accounts", "total_transactions", "total_tickets",
        ).alias("narrative"),
    )
