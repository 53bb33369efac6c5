"""Sources, sinks, change capture, streaming and the refresh graph, with the two-batch fixture."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.operators.changes import apply_changes, snapshot_diff
from strataflow.plans import consumption, curated
from strataflow.plans.refresh import APPEND, TOUCHED, Graph
from strataflow.sources import files, generate, sinks
from strataflow.streaming.alerts import flagged_alerts, ticket_escalations
from strataflow.streaming.ingest import consume, parquet_stream


def test_csv_edge_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        'id,name,amount,doc\n1,"x, y",1.5,"{""k"": ""v""}"\n2,NULL,,\n3,short\n4,long,2.5,d,surplus\n5,bad,oops,d\n', encoding="utf-8"
    )
    schema = "id bigint, name string, amount double, doc string"
    got = files.load_csv(spark, str(tmp_path / "in"), schema, str(tmp_path / "t"), str(tmp_path / "r"))
    assert rows(got.select("id", "name", "amount", "doc"), "id") == [
        (1, "x, y", 1.5, '{"k": "v"}'), (2, None, None, None), (3, "short", None, None), (4, "long", 2.5, "d"),
    ]
    assert rows(spark.read.parquet(str(tmp_path / "r")).select("id", "amount")) == [("5", "oops")]
    assert got.where("_source_file LIKE '%a.csv' AND _loaded_at IS NOT NULL").count() == 4


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', "{\"a\": 1}"), (2, "é", None)], "id int, a string, b string")
    files.write_csv(df, str(tmp_path / "o"))
    back = files.read_csv_text(spark, str(tmp_path / "o"), "id int, a string, b string")
    assert rows(back.select("id", "a", "b"), "id") == [("1", 'say "hi", ok', '{"a": 1}'), ("2", "é", None)]


KV = st.dictionaries(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 3)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=KV, new=KV)
def test_diff_then_apply_gives_new(spark, old, new):
    schema = "k int, v int"
    a, b = spark.createDataFrame(list(old.items()), schema), spark.createDataFrame(list(new.items()), schema)
    changes = snapshot_diff(a, b, ["k"])
    assert rows(apply_changes(a, changes, ["k"]), "k") == sorted(new.items())
    counts = {(r[0], r[1]): r[2] for r in rows(changes.groupBy("_action", "_is_update").count())}
    both = sum(1 for k in old if k in new and old[k] != new[k])
    assert counts.get(("INSERT", True), 0) == counts.get(("DELETE", True), 0) == both
    assert counts.get(("INSERT", False), 0) == len(set(new) - set(old))
    assert counts.get(("DELETE", False), 0) == len(set(old) - set(new))


def test_upsert_twice_is_once(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.upsert(spark, path, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    change = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    for _ in range(2):
        sinks.upsert(spark, path, change, ["k"])
        assert rows(sinks.read_current(spark, path), "k") == [(1, "a"), (2, "B"), (3, "C")]
    assert sinks.current_version(spark, path) == 3


def test_uncommitted_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_version(spark.range(3), path)
    (tmp_path / "t" / "v=2").mkdir()
    assert sinks.current_version(spark, path) == 1
    assert sinks.write_version(spark.range(4), path) == 2


def test_insert_only_keeps_existing(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v int"
    sinks.insert_only(spark, path, spark.createDataFrame([(1, 1)], schema), ["k"], [F.asc("v")])
    sinks.insert_only(spark, path, spark.createDataFrame([(1, 9), (2, 8), (2, 7)], schema), ["k"], [F.asc("v")])
    assert rows(sinks.read_current(spark, path), "k") == [(1, 1), (2, 7)]


def test_stream_restarts_without_duplicates(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.range(10)
    df.write.parquet(f"{src}/a")
    first = consume(parquet_stream(spark, src, df.schema), out, cp)
    again = consume(parquet_stream(spark, src, df.schema), out, cp)
    spark.range(10, 15).write.parquet(f"{src}/b")
    third = consume(parquet_stream(spark, src, df.schema), out, cp, lambda b: b.where("id >= 12"))
    assert (first.rows_in, again.had_data, third.rows_in, third.rows_out) == (10, False, 5, 3)
    assert [r[0] for r in rows(sinks.read_batches(spark, out).select("id"), "id")] == [*range(10), 12, 13, 14]
    # A batch that is written again replaces itself.
    sinks.write_batch(spark.range(10), out, 0)
    assert sinks.read_batches(spark, out).count() == 13


def test_generators_are_repeatable_and_follow_their_rules(spark):
    as_of = F.lit(dt.datetime(2025, 1, 1))
    a = generate.transactions(generate.ids(spark, 300), 50, as_of)
    b = generate.transactions(generate.ids(spark, 300).repartition(7), 50, as_of)
    assert rows(a, "txn_id") == rows(b, "txn_id")
    profile = {m[0]: m for m in generate.MERCHANTS}
    for r in a.collect():
        _, category, low, high, channels = profile[r["merchant_name"]]
        assert r["category"] == category and low <= r["amount"] <= high and r["channel"] in channels
    c = generate.customers(generate.ids(spark, 200), as_of)
    for r in c.collect():
        assert (r["city"], r["state"], r["country"]) in generate.LOCATIONS
        low, high = generate.INCOME[r["employment_status"]]
        assert low <= r["annual_income"] <= high and r["phone"].startswith(generate.DIAL_CODES[r["country"]] + "-")


# Two batches of literal rows: customers, accounts, transactions, tickets.
CUSTOMERS = "customer_id long, customer_name string, email string, city string, country string, annual_income decimal(18,2), employment_status string, credit_score int, signup_date timestamp"
ACCOUNTS = "account_id long, customer_id long, account_type string, balance decimal(18,2), credit_limit decimal(18,2), status string, branch_code string"
TXNS = "txn_id long, account_id long, txn_date timestamp, txn_type string, amount decimal(18,2), merchant_name string, category string, channel string, is_flagged boolean"
TICKETS = "ticket_id long, customer_id long, created_at timestamp, subject string, priority string, resolution_status string, assigned_to string"
D = dt.datetime
BATCHES = [
    {
        "customers": [
            (1, "Aisha Rahman", "aisha.r@example.com", "Dubai", "UAE", Decimal(180000), "EMPLOYED", 780, D(2025, 10, 1, 9)),
            (2, "Marco Rossi", "marco.r@example.com", "Milan", "Italy", Decimal(120000), "SELF_EMPLOYED", 710, D(2025, 10, 5, 14, 30)),
            (3, "Yuna Kim", "yuna.k@example.com", "Seoul", "South Korea", Decimal(95000), "EMPLOYED", 750, D(2025, 10, 10, 10, 15)),
        ],
        "accounts": [
            (11, 1, "CHECKING", Decimal(45000), Decimal(0), "ACTIVE", "DXB-001"), (12, 1, "CREDIT_CARD", Decimal(2500), Decimal(30000), "ACTIVE", "DXB-001"),
            (13, 2, "SAVINGS", Decimal(85000), Decimal(0), "ACTIVE", "MIL-001"), (14, 3, "CHECKING", Decimal(12000), Decimal(0), "ACTIVE", "SEO-001"),
        ],
        "transactions": [
            (1, 11, D(2025, 10, 2, 10, 30), "DEBIT", Decimal("250.00"), "Mall", "SHOPPING", "POS", False),
            (2, 12, D(2025, 10, 2, 15), "DEBIT", Decimal("89.99"), "Video", "ENTERTAINMENT", "ONLINE", False),
            (3, 13, D(2025, 10, 6, 9), "CREDIT", Decimal("15000.00"), "Freelance", "INVESTMENT", "ONLINE", False),
            (4, 14, D(2025, 10, 11, 12, 30), "DEBIT", Decimal("45.00"), "Coffee", "DINING", "POS", False),
            (5, 14, D(2025, 10, 12, 8), "DEBIT", Decimal("5200.00"), "Unknown Offshore", "TRANSFER", "ONLINE", True),
        ],
        "tickets": [
            (1, 3, D(2025, 10, 12, 9), "Suspicious", "HIGH", "OPEN", "Fraud Team"),
            (2, 1, D(2025, 10, 3, 11), "Limit", "MEDIUM", "IN_PROGRESS", "Card Services"),
        ],
    },
    {
        "customers": [
            (4, "Lucas Santos", "lucas.s@example.com", "Rio", "Brazil", Decimal(70000), "EMPLOYED", 690, D(2025, 10, 15)),
            (5, "Emma Wilson", "emma.w@example.com", "Toronto", "Canada", Decimal(80000), "EMPLOYED", 720, D(2025, 10, 16)),
        ],
        "accounts": [],
        "transactions": [
            (6, 13, D(2025, 10, 6, 18), "DEBIT", Decimal("1200.00"), "Rent", "UTILITIES", "ONLINE", False),
            (7, 12, D(2025, 10, 16, 9), "DEBIT", Decimal("350.00"), "Shop", "SHOPPING", "POS", False),
            (8, 14, D(2025, 10, 17, 9), "DEBIT", Decimal("75.50"), "Food", "DINING", "POS", False),
        ],
        "tickets": [],
    },
]
SCHEMAS = {"customers": CUSTOMERS, "accounts": ACCOUNTS, "transactions": TXNS, "tickets": TICKETS}


def test_two_batches_propagate(spark, tmp_path):
    root = str(tmp_path)
    as_of = F.lit(D(2025, 10, 20))
    g = Graph(spark, f"{root}/graph")
    for name in SCHEMAS:
        g.base(name, f"{root}/base/{name}")
    risk = spark.createDataFrame([], "assessment_id long, customer_id long, assessed_at timestamp, risk_data_raw string")
    plain = lambda df: df.drop("_batch_id")
    g.node("profile", ["customers", "accounts"], lambda c, a: curated.customer_profile(plain(c), plain(a), risk))
    g.node("enriched", ["transactions", "accounts", "customers"],
           lambda x, a, c: curated.transaction_enriched(x, plain(a), plain(c)), APPEND)
    g.node("daily", ["enriched"],
           lambda e: consumption.daily_financial_metrics(e).withColumn("month", F.date_format("metric_date", "yyyy-MM")),
           TOUCHED, "month", lambda e: e.withColumn("month", F.date_format("txn_date", "yyyy-MM")))
    g.node("c360", ["profile", "enriched", "tickets"],
           lambda p, e, k: consumption.customer_360(p, plain(e), plain(k), as_of))
    g.node("churn", ["c360"], lambda c: consumption.churn_features(c, as_of))

    seen = []
    for i, batch in enumerate(BATCHES):
        for name, data in batch.items():
            if data or i == 0:
                sinks.write_batch(spark.createDataFrame(data, SCHEMAS[name]), f"{root}/base/{name}", i)
        for name, rule in (("transactions", flagged_alerts), ("tickets", ticket_escalations)):
            schema = spark.createDataFrame([], SCHEMAS[name]).schema
            consume(parquet_stream(spark, f"{root}/base/{name}", schema), f"{root}/raw/{name}", f"{root}/cp/{name}", rule)
        g.refresh("churn")
        g.refresh("daily")
        counts = {n: g.read(n).count() for n in ("customers", "accounts", "transactions", "tickets", "profile", "enriched", "c360", "churn", "daily")}
        counts["alerts"] = sinks.read_batches(spark, f"{root}/raw/transactions").count()
        counts["escalations"] = sinks.read_batches(spark, f"{root}/raw/tickets").count()
        seen.append(counts)
    assert seen[0] == {"customers": 3, "accounts": 4, "transactions": 5, "tickets": 2, "profile": 3, "enriched": 5, "c360": 3,
                       "churn": 3, "daily": 4, "alerts": 1, "escalations": 1}
    delta = {k: seen[1][k] - seen[0][k] for k in seen[0]}
    assert delta == {"customers": 2, "accounts": 0, "transactions": 3, "tickets": 0, "profile": 2, "enriched": 3, "c360": 2,
                     "churn": 2, "daily": 2, "alerts": 0, "escalations": 0}
    assert sinks.read_batches(spark, f"{root}/raw/transactions").first()["alert_reason"] == "HIGH_VALUE_FLAGGED"
    assert sinks.read_batches(spark, f"{root}/raw/tickets").first()["escalation_reason"] == "HIGH_PRIORITY"
    c = {r["customer_id"]: r for r in g.read("c360").collect()}
    assert {r["customer_segment"] for r in c.values()} == {"STANDARD"}
    assert [(c[i]["total_balance"], c[i]["days_since_last_txn"]) for i in (4, 5)] == [(Decimal(0), 999)] * 2
    churned = {r["customer_id"]: r["is_churned"] for r in g.read("churn").collect()}
    assert churned == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1}
    # Incremental tables equal their full recomputation.
    base = {n: plain(g.read(n)) for n in SCHEMAS}
    full = curated.transaction_enriched(base["transactions"], base["accounts"], base["customers"])
    assert rows(plain(g.read("enriched")).select(full.columns), "txn_id") == rows(full, "txn_id")
    want = consumption.daily_financial_metrics(full)
    assert rows(g.read("daily").select(want.columns), "metric_date") == rows(want, "metric_date")
    # A refresh without news does nothing.
    assert {s for _, s in g.refresh("churn")} == {"SKIPPED"}


def test_failed_refresh_is_logged_and_keeps_the_old_version(spark, tmp_path):
    g = Graph(spark, str(tmp_path))
    g.base("b", f"{tmp_path}/b")
    sinks.write_batch(spark.range(3), f"{tmp_path}/b", 0)
    broken = {"on": False}
    g.node("n", ["b"], lambda b: b.select("missing" if broken["on"] else "id"))
    g.refresh("n")
    sinks.write_batch(spark.range(5), f"{tmp_path}/b", 1)
    broken["on"] = True
    with pytest.raises(RuntimeError):
        g.refresh("n")
    assert g.read("n").count() == 3
    assert [r[0] for r in rows(g.log().select("state"), "state")] == ["FAILED", "SUCCEEDED"]
    with pytest.raises(ValueError):
        g.node("x", ["y"], lambda d: d)
        g.node("y", ["x"], lambda d: d)
        g.order("x")
