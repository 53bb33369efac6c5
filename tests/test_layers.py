"""Hand fixtures with edge rows for the curated and consumption layers and the scoring functions."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strataflow.functions import scoring
from strataflow.functions.compat import date_diff
from strataflow.functions.factors import parse_risk_factors, register_table_function
from strataflow.plans import consumption, curated

T0 = dt.datetime(2025, 10, 1)


def risk(score, factors=None, history="GOOD"):
    doc = {"risk_score": score, "credit_history": history, "debt_to_income": 0.3}
    if factors is not None:
        doc["risk_factors"] = factors
    return json.dumps(doc)


@pytest.fixture(scope="module")
def base(spark):
    customers = spark.createDataFrame(
        [(i, f"C{i}", "x@y.zz", "City", "UAE", Decimal(100), "EMPLOYED", 700, dt.date(2025, 1, 1)) for i in (1, 2, 3)],
        "customer_id long, customer_name string, email string, city string, country string, annual_income decimal(18,2), "
        "employment_status string, credit_score int, signup_date date",
    )
    accounts = spark.createDataFrame(
        [(10, 1, "CHECKING", Decimal(45000), Decimal(0), "ACTIVE", "B"), (11, 1, "CREDIT_CARD", Decimal(2500), Decimal(30000), "CLOSED", "B"),
         (12, 2, "SAVINGS", Decimal(85000), Decimal(0), "CLOSED", "B")],
        "account_id long, customer_id long, account_type string, balance decimal(18,2), credit_limit decimal(18,2), status string, branch_code string",
    )
    assessments = spark.createDataFrame(
        [(1, 1, T0, risk(10)), (2, 1, T0, risk(80)), (3, 1, None, risk(99)), (4, 2, T0, "not json")],
        "assessment_id long, customer_id long, assessed_at timestamp, risk_data_raw string",
    )
    return customers, accounts, assessments


def test_profile_edges(base):
    p = {r["customer_id"]: r for r in curated.customer_profile(*base).collect()}
    assert len(p) == 3
    assert (p[1]["total_accounts"], p[1]["active_accounts"], p[1]["total_balance"]) == (2, 1, Decimal(47500))
    assert p[1]["latest_risk_score"] == 80  # same time: higher id; a null time never wins
    assert p[2]["latest_risk_score"] is None and p[2]["last_assessment_date"] == T0
    assert (p[3]["total_accounts"], p[3]["active_accounts"], p[3]["total_balance"]) == (0, 0, Decimal(0))


def test_support_counts_customers_without_accounts(spark, base):
    customers, accounts, _ = base
    tickets = spark.createDataFrame([(1, 3, T0), (2, 1, T0), (3, 99, T0)], "ticket_id long, customer_id long, created_at timestamp")
    got = curated.support_enriched(tickets, customers, accounts, F.lit(T0 + dt.timedelta(hours=5)))
    assert rows(got.select("ticket_id", "customer_accounts", "customer_balance", "ticket_age_hours"), "ticket_id") == [
        (1, 0, None, 5), (2, 2, Decimal(47500), 5), (3, 0, None, 5),
    ]


def test_factor_rows(spark):
    df = spark.createDataFrame(
        [(1, risk(5, [{"factor": "a", "score": 3}, {"score": 4}, "plain"])), (2, risk(6, [])), (3, risk(7)), (4, None), (5, "{bad")],
        "id int, doc string",
    )
    want = [
        (1, 5, "UNKNOWN", 4), (1, 5, "a", 3), (1, 5, "plain", None), (2, 6, "NONE", None), (3, 7, "NONE", None),
    ]
    assert rows(parse_risk_factors(df, "doc").select("id", "risk_score", "factor_name", "factor_score"), "id", "factor_name") == want
    register_table_function(spark)
    sql = spark.sql(
        "SELECT id, f.risk_score, f.factor_name, f.factor_score FROM {d} d, LATERAL parse_risk_factors(d.doc) f", d=df
    )
    assert rows(sql, "id", "factor_name") == want
    flat = curated.risk_factors_parsed(df.withColumnRenamed("doc", "risk_data_raw").where("id < 4"))
    assert flat.where("id > 1").count() == 2  # without factors one row stays


@pytest.mark.parametrize(
    "balance,count,want",
    [(200000, 50, "PLATINUM"), (200000, 49, "GOLD"), (100000, 25, "GOLD"), (25000, 10, "SILVER"), (24999.99, 99, "STANDARD"), (1e9, 9, "STANDARD")],
)
def test_segment_boundaries(spark, balance, count, want):
    df = spark.createDataFrame([(float(balance), count)], "b double, n int")
    assert df.select(scoring.customer_segment("b", "n")).first()[0] == want


def test_tiers_and_labels(spark):
    df = spark.createDataFrame([(80,), (60,), (40,), (20,), (19,)], "s int")
    assert [r[0] for r in df.select(scoring.dashboard_tier("s")).collect()] == ["CRITICAL", "HIGH", "MEDIUM", "LOW", "MINIMAL"]
    churn = spark.createDataFrame([(90, 1), (91, 1), (0, 0)], "d int, a int")
    assert [r[0] for r in churn.select(scoring.churn_label("d", "a")).collect()] == [0, 1, 1]


def test_scoring_functions_agree_with_sql_surface(spark):
    df = spark.createDataFrame(
        [(100.0, 50.0, 10.0), (50.0, 50.0, 0.0), (None, 1.0, 1.0), (60.0, 50.0, 10.0), (1.0, 1.0, None)],
        "a double, m double, s double",
    )
    native = [r[0] for r in df.select(scoring.anomaly_score("a", "m", "s")).collect()]
    assert native == [100.0, 0.0, 0.0, 25.0, 0.0]
    scoring.register_sql_functions(spark)
    assert [r[0] for r in df.selectExpr("anomaly_score(a, m, s)").collect()] == native
    r = spark.createDataFrame(
        [(90.0, 400.0, 2.0), (None, 400.0, 2.0), (50.0, None, None), (10.0, 850.0, 0.1), (60.0, 700.0, 0.5)], "r double, c double, d double"
    )
    native = [x[0] for x in r.select(scoring.risk_tier("r", "c", "d")).collect()]
    assert native == ["CRITICAL", "UNASSESSED", "LOW", "MINIMAL", "HIGH" if 30 + 150 / 850 * 30 + 10 >= 50 else "MEDIUM"]
    assert [x[0] for x in r.selectExpr("risk_tier(r, c, d)").collect()] == native


def test_scoring_stays_in_the_jvm(spark):
    df = spark.range(3).selectExpr("cast(id as double) a")
    plan = df.select(scoring.anomaly_score("a", "a", "a"), scoring.risk_tier("a", "a", "a"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_date_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1))], "a timestamp, b timestamp")
    got = df.select(*[date_diff(u, "a", "b") for u in ("hour", "minute", "day", "second")]).first()
    assert tuple(got) == (1, 2, 0, 120)


def test_market_overview_zero_open(spark):
    df = spark.createDataFrame(
        [("A", 0.0, 5.0, 71.0, 0.0), ("B", None, 5.0, 29.0, 1.0), ("C", 10.0, 11.0, 70.0, -1.0)],
        "ticker string, open_price double, close_price double, rsi double, macd double",
    )
    got = rows(consumption.market_overview(df).select("ticker", "daily_return_pct", "rsi_signal", "macd_signal"), "ticker")
    assert got == [("A", None, "OVERBOUGHT", "BEARISH"), ("B", None, "OVERSOLD", "BULLISH"), ("C", 10.0, "NEUTRAL", "BEARISH")]
