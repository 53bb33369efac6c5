"""Change capture, streaming and refresh (K)."""

from pyspark.sql import functions as F

from ..operators.changes import apply_changes, snapshot_diff
from ..plans import consumption, curated
from ..plans.refresh import APPEND, TOUCHED, Graph, run_report
from ..sources import sinks
from ..sources.keyed import KeyedTable
from ..streaming import windows as sw
from ..streaming.alerts import flagged_alerts, ticket_escalations
from ..streaming.chain import run_chain
from ..streaming.ingest import consume, parquet_stream
from . import build
from .registry import query
from .scratch import scratch


def drops(t, df, root, column, parts=2):
    """Write a table as successive file drops and yield after each."""
    for i in range(parts):
        df.where(F.pmod(F.col(column), F.lit(parts)) == i).write.parquet(f"{root}/in/drop={i}")
        yield i


@query("k01_append_stream", "SELECT event_id, user_id, event_id % 2 AS _batch_id FROM events")
def k01(t):
    root = scratch(t.spark, "k01")
    e = t.raw("events").select("event_id", "user_id")
    for _ in drops(t, e, root, "event_id"):
        consume(parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp")
    out = sinks.read_batches(t.spark, f"{root}/out")
    return out.select("event_id", "user_id", F.col("_batch_id").cast("long").alias("_batch_id"))


def _ticket_snapshots(t):
    """Two states of the tickets: some gone, some changed, some new."""
    x = t.tickets().select("ticket_id", "priority", "resolution_status")
    i = F.col("ticket_id")
    old = x.where(i % 10 != 3)
    new = x.where(i % 10 != 7).withColumn(
        "resolution_status", F.when(i % 5 == 1, "REOPENED").otherwise(F.col("resolution_status"))
    )
    return old, new


DIFF_SQL = """SELECT ticket_id, priority, resolution_status, 'DELETE' AS _action, ticket_id % 10 <> 7 AS _is_update FROM tickets
       WHERE ticket_id % 10 = 7 OR ticket_id % 5 = 1
       UNION ALL SELECT ticket_id, priority, CASE WHEN ticket_id % 5 = 1 THEN 'REOPENED' ELSE resolution_status END, 'INSERT',
              ticket_id % 10 <> 3 FROM tickets WHERE ticket_id % 10 = 3 OR ticket_id % 5 = 1"""


@query("k02_snapshot_diff", DIFF_SQL)
def k02(t):
    return snapshot_diff(*_ticket_snapshots(t), ["ticket_id"])


@query(
    "k02_apply_changes",
    """SELECT ticket_id, priority, CASE WHEN ticket_id % 5 = 1 THEN 'REOPENED' ELSE resolution_status END AS resolution_status
       FROM tickets WHERE ticket_id % 10 <> 7""",
)
def k02b(t):
    old, new = _ticket_snapshots(t)
    return apply_changes(old, snapshot_diff(old, new, ["ticket_id"]), ["ticket_id"])


@query("k03_consume_once", "SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def k03(t):
    root = scratch(t.spark, "k03")
    e = t.raw("events").select("event_id", "event_type", "value")
    for _ in drops(t, e, root, "event_id", 3):
        for _ in range(2):  # a second run finds nothing new
            consume(
                parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp",
                lambda b: b.where(F.col("event_type") == "purchase"),
            )
    return sinks.read_batches(t.spark, f"{root}/out").select("event_id", "value")


@query(
    "k04_has_new_data",
    """SELECT 1 AS run, TRUE AS had_data, COUNT(*) AS rows_in FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT 2, FALSE, 0 UNION ALL SELECT 3, TRUE, COUNT(*) FROM events WHERE event_id % 2 = 1""",
)
def k04(t):
    root = scratch(t.spark, "k04")
    e = t.raw("events").select("event_id", "user_id")
    results = []

    def run():
        r = consume(parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp")
        results.append((len(results) + 1, r.had_data, r.rows_in))

    for i in drops(t, e, root, "event_id"):
        run()
        if i == 0:
            run()
    return t.spark.createDataFrame(results, "run int, had_data boolean, rows_in bigint")


@query(
    "k05_net_change",
    """SELECT user_id, event_id, event_type FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC,
       event_id DESC) = 1""",
)
def k05(t):
    e = t.raw("events").select("user_id", "event_id", "event_type", "ts")
    return sinks.latest_per_key(e, ["user_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


def _graph(t, root):
    g = Graph(t.spark, root)
    g.base("transactions", f"{root}/base/transactions")
    g.base("accounts", f"{root}/base/accounts")
    g.base("customers", f"{root}/base/customers")
    sinks.write_batch(t.accounts(), f"{root}/base/accounts", 0)
    sinks.write_batch(t.customers(), f"{root}/base/customers", 0)

    def enrich(x, a, c):
        return curated.transaction_enriched(x, a.drop("_batch_id"), c.drop("_batch_id"))

    g.node("enriched", ["transactions", "accounts", "customers"], enrich, APPEND)
    # Months, not days, are the unit of recomputation: one file per month instead of one per day.
    g.node(
        "daily",
        ["enriched"],
        lambda e: consumption.daily_financial_metrics(e).withColumn("metric_month", F.date_format("metric_date", "yyyy-MM")),
        TOUCHED,
        "metric_month",
        lambda e: e.withColumn("metric_month", F.date_format("txn_date", "yyyy-MM")),
    )
    g.node("monthly", ["daily"], consumption.monthly_revenue)
    return g


MONTHLY_SQL = """SELECT strftime(revenue_month, '%Y-%m-%d') AS revenue_month, monthly_transactions, monthly_active_customers,
       CAST(monthly_volume AS DOUBLE) AS monthly_volume, monthly_flags, trading_days FROM monthly"""


def _monthly(df):
    return build.days(build.doubles(df, "monthly_volume"), "revenue_month").select(
        "revenue_month", "monthly_transactions", "monthly_active_customers", "monthly_volume", "monthly_flags", "trading_days"
    )


@query("k06_dependency_graph", MONTHLY_SQL)
def k06(t):
    root = scratch(t.spark, "k06")
    g = _graph(t, root)
    sinks.write_batch(t.plain_transactions(), f"{root}/base/transactions", 0)
    g.refresh("monthly")
    return _monthly(g.read("monthly"))


@query(
    "k07_skip_unchanged",
    """SELECT 1 AS run, 'daily' AS node, 'SUCCEEDED' AS state, COUNT(DISTINCT CAST(txn_date AS DATE)) AS days FROM transactions
       UNION ALL SELECT 1, 'enriched', 'SUCCEEDED', COUNT(DISTINCT CAST(txn_date AS DATE)) FROM transactions
       UNION ALL SELECT 2, 'daily', 'SKIPPED', COUNT(DISTINCT CAST(txn_date AS DATE)) FROM transactions
       UNION ALL SELECT 2, 'enriched', 'SKIPPED', COUNT(DISTINCT CAST(txn_date AS DATE)) FROM transactions""",
)
def k07(t):
    root = scratch(t.spark, "k07")
    g = _graph(t, root)
    sinks.write_batch(t.plain_transactions(), f"{root}/base/transactions", 0)
    rows = [(run, node, state) for run in (1, 2) for node, state in g.refresh("daily")]
    days = g.read("daily").agg(F.count("*")).scalar()
    return t.spark.createDataFrame(rows, "run int, node string, state string").withColumn("days", days)


@query("k08_incremental_equals_full", MONTHLY_SQL)
def k08(t):
    root = scratch(t.spark, "k08")
    g = _graph(t, root)
    x = t.plain_transactions()
    late = F.col("txn_date") >= F.lit("2001-01-01").cast("timestamp_ntz")
    for batch, part in enumerate((~late, late & (F.col("line_number") > 3), late & (F.col("line_number") <= 3))):
        sinks.write_batch(x.where(part), f"{root}/base/transactions", batch)
        g.refresh("monthly")
    return _monthly(g.read("monthly"))


@query(
    "k08_incremental_lookup_change",
    """SELECT strftime(m, '%Y-%m') AS month, c_mktsegment AS segment, COUNT(*) AS n,
              CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate END AS m, o_custkey, o_totalprice FROM orders)
       LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
)
def k08_lookup(t):
    """Orders come before their customers, customers change later, and some months are unknown."""
    root = scratch(t.spark, "k08-lookup")
    g = Graph(t.spark, root)
    g.base("orders", f"{root}/base/orders")
    g.base("customers", f"{root}/base/customers")
    orders = t.raw("orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("o_orderkey") % 50 != 0, F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
    )
    customers = t.raw("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))

    def join(o, c):
        latest = sinks.latest_per_key(c, ["c_custkey"], [F.desc("_batch_id")]).drop("_batch_id")
        return o.drop("_batch_id").join(latest, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")

    g.node("joined", ["orders", "customers"], join, APPEND)
    g.node(
        "monthly", ["joined"], lambda j: j.groupBy("month", "segment").agg(F.count("*").alias("n"), F.sum("amount").alias("total")),
        TOUCHED, "month", lambda j: j,
    )
    odd, moved = F.col("c_custkey") % 5 == 0, F.col("c_custkey") % 7 == 0
    sinks.write_batch(customers.where(~odd).withColumn("segment", F.when(moved, "UNKNOWN").otherwise(F.col("segment"))), f"{root}/base/customers", 0)
    for batch, part in enumerate((F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 3 == 0)):
        sinks.write_batch(orders.where(part), f"{root}/base/orders", batch)
        g.refresh("monthly")
    sinks.write_batch(customers.where(odd | moved), f"{root}/base/customers", 1)
    g.refresh("monthly")
    return build.doubles(g.read("monthly"), "total")


@query("k08_replaced_batch", MONTHLY_SQL)
def k08_replaced(t):
    """The second batch comes with wrong months and amounts and without some rows, and is written again under its id."""
    root = scratch(t.spark, "k08-replaced")
    g = _graph(t, root)
    x = t.plain_transactions()
    second = F.col("line_number") % 2 == 0
    sinks.write_batch(x.where(~second), f"{root}/base/transactions", 0)
    g.refresh("monthly")
    wrong = x.where(second & (F.col("line_number") < 6)).withColumns(
        {"txn_date": F.col("txn_date") - F.make_dt_interval(F.lit(45)), "amount": (F.col("amount") + 1).cast(x.schema["amount"].dataType)}
    )
    sinks.write_batch(wrong, f"{root}/base/transactions", 1)
    g.refresh("monthly")
    sinks.write_batch(x.where(second), f"{root}/base/transactions", 1)
    g.refresh("monthly")
    return _monthly(g.read("monthly"))


@query("k08_late_batch", MONTHLY_SQL)
def k08_late(t):
    """Batches come with ids out of order, and one that should not be there is taken away."""
    root = scratch(t.spark, "k08-late")
    g = _graph(t, root)
    x = t.plain_transactions()
    for batch, line in ((5, 1), (3, 2), (4, None)):
        part = x.where(F.col("line_number") == line) if line else x.where(F.col("line_number") > 2)
        sinks.write_batch(part, f"{root}/base/transactions", batch)
        if batch == 3:
            sinks.write_batch(x.withColumn("txn_date", F.col("txn_date") + F.make_dt_interval(F.lit(4000))), f"{root}/base/transactions", 9)
        g.refresh("monthly")
    sinks.drop_folder(t.spark, f"{root}/base/transactions/_batch_id=9")
    g.refresh("monthly")
    return _monthly(g.read("monthly"))


@query(
    "k09_flagged_alerts",
    """SELECT account_id, txn_id, part_id, supplier_id, CAST(amount AS DOUBLE) AS amount,
              CASE WHEN amount > 5000 THEN 'HIGH_VALUE_FLAGGED' WHEN merchant_name ILIKE '%offshore%' THEN 'SUSPICIOUS_MERCHANT'
                   ELSE 'FLAGGED_TRANSACTION' END AS alert_reason FROM transactions WHERE is_flagged""",
)
def k09(t):
    root = scratch(t.spark, "k09")
    x = t.transactions().select(
        "account_id", "txn_id", "part_id", "supplier_id", "amount", "merchant_name", "is_flagged", "line_number"
    )
    for _ in drops(t, x, root, "line_number"):
        consume(parquet_stream(t.spark, f"{root}/in", x.schema), f"{root}/alerts", f"{root}/cp", flagged_alerts)
    a = sinks.read_batches(t.spark, f"{root}/alerts")
    return build.doubles(a, "amount").select("account_id", "txn_id", "part_id", "supplier_id", "amount", "alert_reason")


@query(
    "k10_ticket_escalations",
    f"""SELECT ticket_id, priority, resolution_status, priority || '_PRIORITY' AS escalation_reason FROM ({DIFF_SQL})
        WHERE _action = 'INSERT' AND priority IN ('HIGH', 'CRITICAL')""",
)
def k10(t):
    changes = snapshot_diff(*_ticket_snapshots(t), ["ticket_id"])
    return ticket_escalations(changes, ("HIGH", "CRITICAL")).select(
        "ticket_id", "priority", "resolution_status", "escalation_reason"
    )


@query(
    "k10_chain_update",
    """SELECT ticket_id, priority, priority || '_PRIORITY' AS escalation_reason,
              CAST(1 + (ticket_id % 7 = 0 AND ticket_id % 5 <> 1 AND ticket_id % 10 <> 3)::INT AS BIGINT) AS times
       FROM tickets WHERE priority IN ('HIGH', 'CRITICAL')""",
)
def k10_chain(t):
    """Tickets are merged by key and the chain follows the table's feed: raised, new and touched tickets escalate once for
    each change, unchanged ones in the same merge do not."""
    root = scratch(t.spark, "k10-chain")
    x = t.transactions().select("account_id", "txn_id", "amount", "merchant_name", "is_flagged", "txn_date")
    x.where("is_flagged").write.parquet(f"{root}/in/transactions")
    k = t.tickets()
    i = F.col("ticket_id")
    table = KeyedTable(t.spark, f"{root}/base/tickets", ("ticket_id",), k.schema, buckets=8)
    raised, new, touched = i % 5 == 1, i % 10 == 3, i % 7 == 0

    def trigger():
        run_chain(
            t.spark,
            parquet_stream(t.spark, f"{root}/in/transactions", x.schema),
            parquet_stream(t.spark, table.feed, table.feed_schema),
            lambda: consumption.metrics_snapshot(t.customers(), t.accounts(), x, table.read(), build.as_of()),
            root,
            priorities=("HIGH", "CRITICAL"),
        )

    table.upsert(k.where(~new).withColumn("priority", F.when(raised, "LOW").otherwise(F.col("priority"))))
    trigger()
    table.upsert(k.withColumn("resolution_status", F.when(touched, "REOPENED BY CUSTOMER").otherwise(F.col("resolution_status"))))
    trigger()
    trigger()  # nothing is new
    done = sinks.read_batches(t.spark, f"{root}/raw/escalations")
    return done.groupBy("ticket_id", "priority", "escalation_reason").agg(F.count("*").alias("times"))


@query(
    "k11_stream_velocity",
    """SELECT user_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, COUNT(*) AS n,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM (SELECT user_id, value, time_bucket(INTERVAL 15 MINUTE, ts) - i * INTERVAL 15 MINUTE AS w
             FROM events CROSS JOIN range(4) r(i)) GROUP BY user_id, w""",
)
def k11(t):
    root = scratch(t.spark, "k11")
    e = t.raw("events").select("event_id", "ts", "user_id", F.col("value").cast("decimal(18,2)").alias("amount"))
    e.write.parquet(f"{root}/in/drop=0")
    sw.run_windows(
        parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp", "ts", "1 hour", "15 minutes", ["user_id"],
        [F.count("*").alias("n"), F.sum("amount").alias("amount")],
    )
    out = sw.current_windows(t.spark, f"{root}/out", ["user_id"]).drop("window_end")
    return build.texts(build.doubles(out, "amount"), "window_start")


STREAM_DAILY_SQL = """SELECT event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS metric_date, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2"""


def _stream_daily(t, name, drops):
    """Daily metrics of events that arrive in several drops, each given by a condition."""
    root = scratch(t.spark, name)
    e = t.raw("events").select("event_id", "ts", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    for i, part in enumerate(drops(e)):
        e.where(part).write.parquet(f"{root}/in/drop={i}")
        sw.run_windows(
            parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp", "ts", "1 day", None, ["event_type"],
            [F.count("*").alias("n"), F.sum("value").alias("total")],
        )
    out = sw.current_windows(t.spark, f"{root}/out", ["event_type"])
    return build.days(build.doubles(out, "total").withColumnRenamed("window_start", "metric_date"), "metric_date").drop("window_end")


@query("k12_stream_daily_metrics", STREAM_DAILY_SQL)
def k12(t):
    def drops(e):
        # Two drops in time order; the second starts inside a day, so its windows are updated.
        middle = e.agg(F.max("event_id") / 2).first()[0]
        return F.col("event_id") < middle, F.col("event_id") >= middle

    return _stream_daily(t, "k12", drops)


@query("k12_late_rows", STREAM_DAILY_SQL)
def k12_late(t):
    # Every 97th event comes last, days after the other events of its window.
    return _stream_daily(t, "k12-late", lambda e: (F.col("event_id") % 97 != 0, F.col("event_id") % 97 == 0))


CHAIN_SQL = """SELECT '2001-12-31' AS metric_date, (SELECT COUNT(*) FROM customers) AS total_customers,
       (SELECT COUNT(*) FROM transactions) AS total_transactions, (SELECT COUNT(*) FROM tickets) AS total_tickets,
       (SELECT COUNT(*) FROM transactions WHERE is_flagged) AS alerts,
       (SELECT COUNT(*) FROM tickets WHERE priority IN ('HIGH', 'CRITICAL')) AS escalations"""


def _chain(t, triggers):
    root = scratch(t.spark, "chain")
    x = t.transactions().select("account_id", "txn_id", "amount", "merchant_name", "is_flagged", "txn_date")
    k = t.tickets()
    x.write.parquet(f"{root}/in/transactions")
    k.write.parquet(f"{root}/in/tickets")
    for _ in range(triggers):
        run_chain(
            t.spark,
            parquet_stream(t.spark, f"{root}/in/transactions", x.schema),
            parquet_stream(t.spark, f"{root}/in/tickets", k.schema),
            lambda: consumption.metrics_snapshot(t.customers(), t.accounts(), x, k, build.as_of()),
            root,
            priorities=("HIGH", "CRITICAL"),
        )
    from ..operators.reshape import combine_single_rows

    def count(name):
        return sinks.read_batches(t.spark, f"{root}/raw/{name}").agg(F.count("*").alias(name))

    snap = sinks.read_current(t.spark, f"{root}/consumption/metrics_snapshot")
    both = combine_single_rows([snap, count("alerts"), count("escalations")])
    return build.days(both, "metric_date").select(
        "metric_date", "total_customers", "total_transactions", "total_tickets", "alerts", "escalations"
    )


@query("k13_event_chain", CHAIN_SQL)
def k13(t):
    return _chain(t, 1)


@query("k14_manual_trigger_twice", CHAIN_SQL)
def k14(t):
    return _chain(t, 2)


@query(
    "k15_two_batch_propagation",
    """SELECT stage, table_name, row_count FROM (
         SELECT 1 AS stage, 'transactions' AS table_name, COUNT(*) AS row_count FROM transactions WHERE line_number <= 4
         UNION ALL SELECT 1, 'enriched', COUNT(*) FROM enriched WHERE line_number <= 4
         UNION ALL SELECT 1, 'daily', COUNT(DISTINCT CAST(txn_date AS DATE)) FROM enriched WHERE line_number <= 4
         UNION ALL SELECT 2, 'transactions', COUNT(*) FROM transactions
         UNION ALL SELECT 2, 'enriched', COUNT(*) FROM enriched
         UNION ALL SELECT 2, 'daily', COUNT(DISTINCT CAST(txn_date AS DATE)) FROM enriched)""",
)
def k15(t):
    from ..operators.reshape import labelled_counts, union_all
    from ..session import stage

    root = scratch(t.spark, "k15")
    g = _graph(t, root)
    x = t.plain_transactions()
    seen = []
    for i, part in enumerate((F.col("line_number") <= 4, F.col("line_number") > 4)):
        sinks.write_batch(x.where(part), f"{root}/base/transactions", i)
        g.refresh("daily")
        counts = labelled_counts({n: g.read(n) for n in ("transactions", "enriched", "daily")})
        seen.append(stage(counts.withColumn("stage", F.lit(i + 1))))
    return union_all(seen)


@query(
    "k16_refresh_history",
    """SELECT CAST(run_id AS BIGINT) AS run_id, node, state, mode, n_days FROM (
         SELECT 1 AS run_id, 'daily' AS node, 'SUCCEEDED' AS state, 'touched' AS mode UNION ALL
         SELECT 1, 'enriched', 'SUCCEEDED', 'append' UNION ALL SELECT 1, 'monthly', 'SUCCEEDED', 'full' UNION ALL
         SELECT 2, 'daily', 'SKIPPED', 'touched' UNION ALL SELECT 2, 'enriched', 'SKIPPED', 'append' UNION ALL
         SELECT 2, 'monthly', 'SKIPPED', 'full'),
         (SELECT COUNT(DISTINCT CAST(txn_date AS DATE)) AS n_days FROM transactions)""",
)
def k16(t):
    root = scratch(t.spark, "k16")
    g = _graph(t, root)
    sinks.write_batch(t.plain_transactions(), f"{root}/base/transactions", 0)
    g.refresh("monthly")
    g.refresh("monthly")
    n = g.read("daily").agg(F.count("*")).scalar()
    r = run_report(g.log()).where(F.col("seconds") >= 0)
    return r.select("run_id", "node", "state", "mode", n.alias("n_days"))


@query(
    "k17_batch_verification",
    """SELECT event_id % 3 AS _batch_id, COUNT(*) AS n_rows, CAST(COUNT_IF(event_type = 'error') AS BIGINT) AS flagged,
              strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_row, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_row
       FROM events GROUP BY 1""",
)
def k17(t):
    root = scratch(t.spark, "k17")
    e = t.raw("events").select("event_id", "ts", "event_type")
    for _ in drops(t, e, root, "event_id", 3):
        consume(parquet_stream(t.spark, f"{root}/in", e.schema), f"{root}/out", f"{root}/cp")
    g = sinks.read_batches(t.spark, f"{root}/out").groupBy(F.col("_batch_id").cast("long").alias("_batch_id")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("event_type") == "error").alias("flagged"),
        F.min("ts").alias("first_row"), F.max("ts").alias("last_row"),
    )
    return build.texts(g, "first_row", "last_row")
