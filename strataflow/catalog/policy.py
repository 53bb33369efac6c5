"""Security and governance queries (G)."""

from pyspark.sql import functions as F

from ..functions.compat import dbl_avg
from ..operators import policy as p
from . import build
from .registry import query

ANALYST = p.SessionContext("analyst_us", frozenset({"ANALYST"}))
AGENT = p.SessionContext("support_1", frozenset({"SUPPORT_AGENT"}))
ENGINEER = p.SessionContext("engineer", frozenset({"DATA_ENGINEER"}))


def registry():
    r = p.PolicyRegistry()
    r.masks[("customers", "customer_name")] = p.MaskPolicy(p.mask_text)
    r.masks[("customers", "email")] = p.MaskPolicy(p.mask_text)
    r.masks[("customers", "date_of_birth")] = p.MaskPolicy(p.mask_date)
    r.masks[("customers", "annual_income")] = p.MaskPolicy(p.mask_constant(p.MASK_NUMBER))
    r.masks[("customers", "credit_score")] = p.MaskPolicy(p.mask_constant(p.MASK_CREDIT))
    for c in ("balance", "credit_limit"):
        r.masks[("accounts", c)] = p.MaskPolicy(p.mask_constant(p.MASK_NUMBER), p.MONEY_ACCESS)
    for column, tag in (("customer_name", "PII"), ("email", "PII"), ("country", "INTERNAL"), ("credit_score", "SENSITIVE")):
        r.tag("data_classification", tag, "customers", column)
    r.tag("data_classification", "RESTRICTED", "accounts", "balance")
    r.tag("data_owner", "PLATFORM_TEAM", "customers")
    r.tag("retention_policy", "7_YEARS", "accounts")
    return r


@query(
    "g01_text_mask",
    "SELECT customer_id, '***MASKED***' AS customer_name, '***MASKED***' AS email FROM customers",
)
def g01(t):
    return registry().apply(t.customers(), "customers", ANALYST).select("customer_id", "customer_name", "email")


@query(
    "g02_date_mask",
    """SELECT customer_id, strftime(make_date(CAST(year(date_of_birth) AS INTEGER), 1, 1), '%Y-%m-%d') AS date_of_birth
       FROM customers""",
)
def g02(t):
    masked = registry().apply(t.customers(), "customers", ANALYST)
    return build.days(masked.select("customer_id", "date_of_birth"), "date_of_birth")


@query(
    "g03_number_masks",
    "SELECT customer_id, CAST(-1 AS DOUBLE) AS annual_income, 0 AS credit_score FROM customers",
)
def g03(t):
    masked = registry().apply(t.customers(), "customers", ANALYST)
    return build.doubles(masked.select("customer_id", "annual_income", "credit_score"), "annual_income")


@query(
    "g04_role_sets",
    """SELECT account_id, 'analyst' AS seen_by, CAST(balance AS DOUBLE) AS balance FROM accounts
       UNION ALL SELECT account_id, 'engineer', -1.0 FROM accounts""",
)
def g04(t):
    r = registry()

    def seen(ctx, label):
        a = r.apply(t.accounts(), "accounts", ctx)
        return a.select("account_id", F.lit(label).alias("seen_by"), F.col("balance").cast("double").alias("balance"))

    return seen(ANALYST, "analyst").unionByName(seen(ENGINEER, "engineer"))


def agent_map(t):
    """Users and the team each may see, derived from the nations."""
    teams = F.array(*[F.lit(x) for x in ("Support Team", "Fraud Team", "Card Services", "Tech Support", "Compliance")])
    n = t.raw("nation")
    return n.select(
        F.concat(F.lit("support_"), F.col("n_nationkey").cast("string")).alias("user"),
        F.get(teams, F.col("n_nationkey") % 5).alias("team"),
    )


@query(
    "g05_row_policy_assignment",
    "SELECT ticket_id, assigned_to FROM tickets WHERE assigned_to = 'Fraud Team'",
)
def g05(t):
    rp = p.RowPolicy("assigned_to", agent_map(t), "user", "team", frozenset({"SUPPORT_AGENT"}))
    return rp.apply(t.tickets(), AGENT).select("ticket_id", "assigned_to")


@query(
    "g06_row_policy_country",
    "SELECT customer_id, country FROM customers WHERE city = 'AMERICA'",
)
def g06(t):
    n, r = t.raw("nation"), t.raw("region")
    mapping = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.when(F.col("r_name") == "AMERICA", "analyst_us").otherwise("analyst_other").alias("user"),
        F.col("n_name").alias("country"),
    )
    rp = p.RowPolicy("country", mapping, "user", "country", frozenset({"ANALYST"}), default_allow=True)
    return rp.apply(t.customers(), ANALYST).select("customer_id", "country")


@query(
    "g07_tag_masking",
    """SELECT customer_id, '***MASKED***' AS customer_name, left(employment_status, 1) || '***' AS employment_status,
              strftime(make_date(CAST(year(signup_date) AS INTEGER), 1, 1), '%Y-%m-%d') AS signup_date, country,
              -1 AS credit_score FROM customers""",
)
def g07(t):
    r = p.PolicyRegistry()
    for column, tag in (
        ("customer_name", "PII"), ("employment_status", "SENSITIVE"), ("signup_date", "RESTRICTED"),
        ("country", "PUBLIC"), ("credit_score", "SENSITIVE"),
    ):
        r.tag("data_classification", tag, "customers", column)
    masked = r.apply(t.customers(), "customers", ENGINEER)
    return build.days(
        masked.select("customer_id", "customer_name", "employment_status", "signup_date", "country", "credit_score"),
        "signup_date",
    )


@query(
    "g08_tag_assignments",
    """SELECT 'customers' AS table_name, 'email' AS column_name, 'PII' AS tag_value, COUNT(email) AS tagged_values FROM customers
       UNION ALL SELECT 'customers', 'country', 'INTERNAL', COUNT(country) FROM customers""",
)
def g08(t):
    r = registry()
    tags = r.as_frame(t.spark).where((F.col("tag_name") == "data_classification") & F.col("column_name").isin("email", "country"))
    counts = t.customers().agg(F.count("email").alias("email"), F.count("country").alias("country"))
    long = counts.unpivot([], ["email", "country"], "column_name", "tagged_values")
    return tags.select("table_name", "column_name", "tag_value").join(long, "column_name")


@query(
    "g09_auto_classification",
    """SELECT column_name, pattern, ROUND(CAST(hits AS DOUBLE) / n, 4) AS share, name_hint,
              CASE WHEN CAST(hits AS DOUBLE) / n >= 0.5 THEN CASE WHEN pattern = 'code' THEN 'INTERNAL' ELSE 'PII' END END AS proposed
       FROM (SELECT c.column_name, p.pattern, c.name_hint, COUNT(*) AS n, COUNT_IF(regexp_matches(c.v, p.rx)) AS hits
             FROM (SELECT 'email' AS column_name, 'PII' AS name_hint, email AS v FROM customers
                   UNION ALL SELECT 'customer_name', 'PII', customer_name FROM customers
                   UNION ALL SELECT 'city', NULL, city FROM customers
                   UNION ALL SELECT 'country', NULL, country FROM customers
                   UNION ALL SELECT 'employment_status', NULL, employment_status FROM customers) c
             JOIN (VALUES ('email', '^[^@ ]+@[^@ ]+\\.[a-z]{2,}$'),
                          ('phone', '^\\+?[0-9]{1,3}-[0-9]{2,4}-[0-9]{3,4}(-[0-9]{3,4})?$'),
                          ('name', '^[A-Z][a-z]+#[0-9]+$'), ('code', '^[A-Z]{2}-[0-9]{3}$')) p(pattern, rx) ON TRUE
             GROUP BY c.column_name, p.pattern, c.name_hint)""",
)
def g09(t):
    return p.classify_columns(t.customers())


@query(
    "g10_min_group_size",
    """SELECT country, employment_status, credit_score // 50 AS band, COUNT(*) AS customers,
              CAST(SUM(annual_income) AS DOUBLE) / COUNT(*) AS avg_income FROM customers GROUP BY 1, 2, 3 HAVING COUNT(*) >= 5""",
)
def g10(t):
    c = t.customers().withColumn("band", F.expr("cast(credit_score div 50 as int)"))
    return p.guarded_aggregate(
        c, ["country", "employment_status", "band"],
        [F.count("*").alias("customers"), dbl_avg("annual_income").alias("avg_income")], ANALYST,
    )


@query(
    "g11_projection_guard",
    "SELECT customer_id, country FROM customers WHERE email LIKE '%@machinery.com'",
)
def g11(t):
    guarded = p.GuardedFrame(t.customers(), ["email"], ANALYST)
    return guarded.where(F.col("email").like("%@machinery.com")).select("customer_id", "country")


@query(
    "g12_policy_coverage",
    """SELECT 'customers' AS table_name, COUNT(*) AS customers_seen, 10 AS total_columns, 4 AS classified_columns,
              5 AS masked_columns FROM customers
       UNION ALL SELECT 'accounts', COUNT(*), 8, 1, 2 FROM accounts""",
)
def g12(t):
    from ..operators.reshape import labelled_counts

    tables = {"customers": t.customers(), "accounts": t.accounts()}
    cov = p.coverage(registry().as_frame(t.spark), p.columns_frame(t.spark, tables))
    seen = labelled_counts(tables, count="customers_seen")
    return seen.join(cov, "table_name").select(
        "table_name", "customers_seen",
        *[F.col(c).cast("int").alias(c) for c in ("total_columns", "classified_columns", "masked_columns")],
    )


@query(
    "g13_role_closure",
    """WITH RECURSIVE edges AS (SELECT n_name AS role, r_name AS inherits FROM nation JOIN region ON n_regionkey = r_regionkey
                                UNION ALL SELECT c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
                                UNION ALL SELECT r_name, 'ADMIN' FROM region),
       closure(role, inherited) AS (SELECT role, inherits FROM edges UNION
              SELECT c.role, e.inherits FROM closure c JOIN edges e ON c.inherited = e.role)
       SELECT DISTINCT role, inherited FROM closure""",
)
def g13(t):
    n, r, c = t.raw("nation"), t.raw("region"), t.raw("customer")
    edges = (
        n.join(r, n.n_regionkey == r.r_regionkey)
        .select(F.col("n_name").alias("role"), F.col("r_name").alias("inherits"))
        .unionByName(c.join(n, c.c_nationkey == n.n_nationkey).select(F.col("c_name").alias("role"), F.col("n_name").alias("inherits")))
        .unionByName(r.select(F.col("r_name").alias("role"), F.lit("ADMIN").alias("inherits")))
    )
    return p.resolve_roles(edges)


@query(
    "g14_retention",
    """SELECT account_id, strftime(opened_date, '%Y-%m-%d') AS opened_date FROM accounts
       WHERE opened_date < DATE '2001-12-31' - INTERVAL 3 YEAR""",
)
def g14(t):
    old = p.retention_filter(t.accounts(), "opened_date", "3_YEARS", build.as_of(), expired=True)
    return build.days(old.select("account_id", "opened_date"), "opened_date")


@query("g15_default_allow", "SELECT ticket_id, assigned_to FROM tickets")
def g15(t):
    return p.RowPolicy("assigned_to", default_allow=True).apply(t.tickets(), ENGINEER).select("ticket_id", "assigned_to")


@query(
    "b25_governance_summary",
    """SELECT CAST(COUNT(*) FILTER (WHERE hit) AS BIGINT) AS classified_columns, COUNT(*) AS total_columns,
              ROUND(COUNT(*) FILTER (WHERE hit) * 100.0::DOUBLE / COUNT(*), 1) AS classification_pct,
              CAST(7 AS BIGINT) AS masked_columns
       FROM (SELECT MAX(CASE WHEN email LIKE '%@%' THEN 1 ELSE 0 END) = 1 AS hit FROM customers
             UNION ALL SELECT MAX(CASE WHEN customer_name LIKE 'Customer#%' THEN 1 ELSE 0 END) = 1 FROM customers
             UNION ALL SELECT COUNT(city) < 0 FROM customers UNION ALL SELECT COUNT(country) < 0 FROM customers
             UNION ALL SELECT COUNT(employment_status) < 0 FROM customers)""",
)
def b25(t):
    from ..operators.reshape import combine_single_rows

    found = p.classify_columns(t.customers()).groupBy("column_name").agg(F.max("proposed").alias("proposed"))
    classified = F.count("proposed")
    row = found.agg(
        classified.alias("classified_columns"), F.count("*").alias("total_columns"),
        F.round(classified * 100.0 / F.count("*"), 1).alias("classification_pct"),
    )
    masks = registry().as_frame(t.spark).where(F.col("kind") == "MASK").agg(F.count("*").alias("masked_columns"))
    return combine_single_rows([row, masks])
