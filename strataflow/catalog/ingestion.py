"""Sources and sinks (S). Each query moves a given table through the operator and returns the result."""

from pyspark.sql import functions as F
from ..sources import files, generate, sinks
from ..sources.keyed import KeyedTable
from ..streaming.ingest import ingest_csv
from . import build
from .registry import query
from .scratch import scratch

EVENT_FILE = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def export_events(t, folder, condition=None):
    """Events as CSV with the awkward cases: NULL texts, empty fields, numbers that do not parse."""
    i = F.col("event_id")
    e = t.raw("events")
    e = e.where(condition) if condition is not None else e
    rows = e.select(
        i.cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        F.when(i % 31 == 0, "NULL").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(i % 13 == 0, "").otherwise(F.col("event_type")).alias("event_type"),
        F.when(i % 97 == 0, "oops").otherwise(F.col("value").cast("string")).alias("value"),
        "props",
    )
    files.write_csv(rows, folder)


LOADED_SQL = """SELECT event_id, CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type, value,
       CAST(props->>'$.k' AS INTEGER) AS k FROM events WHERE event_id % 97 <> 0"""


def loaded(df):
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    return df.select("event_id", "user_id", "event_type", "value", k)


@query(
    "s01_table_scan",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
)
def s01(t):
    t.raw("orders").createOrReplaceTempView("base_orders")
    return t.spark.table("base_orders").where(F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderstatus")


@query(
    "s02_csv_scan",
    """SELECT event_id, CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
              CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS event_type, props FROM events""",
)
def s02(t):
    folder = scratch(t.spark, "csv")
    export_events(t, folder)
    text = files.read_csv_text(t.spark, folder, EVENT_FILE)
    return text.select(F.col("event_id").cast("long").alias("event_id"), "user_id", "event_type", "props")


@query("s03_bulk_load_skip_bad", LOADED_SQL)
def s03(t):
    root = scratch(t.spark, "load")
    export_events(t, f"{root}/in")
    return loaded(files.load_csv(t.spark, f"{root}/in", EVENT_FILE, f"{root}/rows", f"{root}/rejects"))


@query("s03_load_rejects", "SELECT event_id, 'oops' AS value, 'value' AS bad FROM events WHERE event_id % 97 = 0")
def s03b(t):
    root = scratch(t.spark, "load")
    export_events(t, f"{root}/in")
    files.load_csv(t.spark, f"{root}/in", EVENT_FILE, f"{root}/rows", f"{root}/rejects")
    r = t.spark.read.parquet(f"{root}/rejects")
    return r.select(F.col("event_id").cast("long").alias("event_id"), "value", F.array_join("_bad_columns", ",").alias("bad"))


@query("s04_forced_reload", LOADED_SQL)
def s04(t):
    root = scratch(t.spark, "reload")
    export_events(t, f"{root}/in")
    files.load_csv(t.spark, f"{root}/in", EVENT_FILE, f"{root}/rows")
    return loaded(files.load_csv(t.spark, f"{root}/in", EVENT_FILE, f"{root}/rows", mode="overwrite"))


@query("s05_continuous_ingestion", LOADED_SQL)
def s05(t):
    root = scratch(t.spark, "stream")
    export_events(t, f"{root}/in/drop=1", F.col("event_id") % 2 == 0)
    args = (t.spark, f"{root}/in/*", EVENT_FILE, f"{root}/rows", f"{root}/rejects", f"{root}/checkpoint")
    ingest_csv(*args)
    export_events(t, f"{root}/in/drop=2", F.col("event_id") % 2 == 1)
    ingest_csv(*args)
    ingest_csv(*args)
    return loaded(sinks.read_batches(t.spark, f"{root}/rows"))


@query(
    "s06_load_audit_columns",
    "SELECT COUNT(*) AS n_rows, COUNT(*) AS with_time, COUNT(*) AS with_file FROM events WHERE event_id % 97 <> 0",
)
def s06(t):
    root = scratch(t.spark, "audit")
    export_events(t, f"{root}/in")
    r = files.load_csv(t.spark, f"{root}/in", EVENT_FILE, f"{root}/rows")
    return r.agg(
        F.count("*").alias("n_rows"),
        F.count("_loaded_at").alias("with_time"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("with_file"),
    )


@query("s07_parsed_view", "SELECT event_id, k FROM ev WHERE k >= 50")
def s07(t):
    v = files.parsed_view(t.spark, t.raw("events"), "props", "doc", "landed_events")
    return v.selectExpr("event_id", "variant_get(doc, '$.k', 'int') AS k").where("k >= 50")


def _ids(t, table, key):
    return t.raw(table).select((F.col(key) + 1).alias("id"))


def _as_of():
    return F.lit("2025-01-01").cast("timestamp")


@query("s08_row_generator", "SELECT COUNT(*) AS n_rows, COUNT(*) AS distinct_ids FROM customer")
def s08(t):
    n = t.raw("customer").count()
    return generate.ids(t.spark, n).agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("distinct_ids"))


@query(
    "s09_synthetic_customers",
    "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violations, CAST(22 AS BIGINT) AS places FROM customer",
)
def s09(t):
    c = generate.customers(_ids(t, "customer", "c_custkey"), _as_of())
    bad = (
        ~F.col("credit_score").between(300, 850)
        | (F.col("annual_income") < 0)
        | ~F.col("email").like("%_@_%.__%")
        | F.col("phone").isNull()
        | F.col("country").isNull()
    )
    return c.agg(
        F.count("*").alias("n_rows"), F.count_if(bad).alias("violations"), F.countDistinct("city").alias("places")
    )


@query(
    "s10_synthetic_accounts_market_documents",
    """SELECT 'accounts' AS table_name, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violations FROM orders
       UNION ALL SELECT 'market', COUNT(*), 0 FROM events UNION ALL SELECT 'documents', COUNT(*), 0 FROM documents""",
)
def s10(t):
    from ..operators.reshape import union_all
    from ..plans.curated import compliance_enriched, market_parsed

    a = generate.accounts(_ids(t, "orders", "o_orderkey"), 2000, _as_of())
    m = market_parsed(generate.market_data(_ids(t, "events", "event_id"), _as_of()))
    d = compliance_enriched(generate.compliance_documents(_ids(t, "documents", "doc_id"), _as_of()))
    card = F.col("account_type") == "CREDIT_CARD"

    def report(name, df, bad):
        r = df.agg(F.count("*").alias("n_rows"), F.count_if(bad).alias("violations"))
        return r.select(F.lit(name).alias("table_name"), "n_rows", "violations")

    return union_all(
        [
            report("accounts", a, (card != (F.col("credit_limit") > 0)) | (F.col("balance") < 0)),
            report("market", m, ~F.col("rsi").between(10, 90) | F.col("close_price").isNull()),
            report("documents", d, F.col("regulatory_body").isNull() | (F.col("content_length") == 0)),
        ]
    )


@query(
    "s11_synthetic_transactions",
    "SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violations, CAST(31 AS BIGINT) AS merchants FROM orders",
)
def s11(t):
    x = generate.transactions(_ids(t, "orders", "o_orderkey"), 3000, _as_of())
    bad = (
        (F.col("amount") <= 0)
        | (F.col("amount") > 5000)
        | ((F.col("category") == "TRANSFER") != (F.col("txn_type") == "TRANSFER"))
        | F.col("channel").isNull()
    )
    return x.agg(
        F.count("*").alias("n_rows"), F.count_if(bad).alias("violations"),
        F.countDistinct("merchant_name").alias("merchants"),
    )


@query(
    "s12_synthetic_tickets_assessments",
    """SELECT 'tickets' AS table_name, COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS violations FROM events
       UNION ALL SELECT 'assessments', COUNT(*), 0 FROM events""",
)
def s12(t):
    from ..plans.curated import risk_parsed

    k = generate.tickets(_ids(t, "events", "event_id"), 2000, _as_of())
    r = risk_parsed(generate.risk_assessments(_ids(t, "events", "event_id"), 2000, _as_of()))
    names = F.transform("risk_factors", lambda f: f["factor"])
    a = k.agg(F.count("*").alias("n_rows"), F.count_if(F.col("priority").isNull()).alias("violations"))
    b = r.agg(
        F.count("*").alias("n_rows"),
        F.count_if((F.size(F.array_distinct(names)) != 3) | ~F.col("debt_to_income").between(0.05, 0.8)).alias("violations"),
    )
    return a.withColumn("table_name", F.lit("tickets")).unionByName(b.withColumn("table_name", F.lit("assessments")))


@query(
    "s13_micro_batch_append",
    """SELECT event_id % 5 AS _batch_id, COUNT(*) AS n_rows, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
              CAST(COUNT_IF(event_type = 'error') AS BIGINT) AS flagged FROM events GROUP BY 1""",
)
def s13(t):
    e = t.raw("events").withColumn("amount", F.col("value").cast("decimal(18,2)"))
    r = sinks.micro_batches(
        e, scratch(t.spark, "batches"), F.col("event_id") % 5, F.col("event_type") == "error", "amount"
    )
    return r.withColumn("_batch_id", F.col("_batch_id").cast("long"))


@query(
    "s14_insert_only_merge",
    """SELECT user_id, event_type, MIN(event_id) AS event_id FROM events GROUP BY user_id, event_type""",
)
def s14(t):
    path = scratch(t.spark, "insert-only")
    e = t.raw("events").select("user_id", "event_type", "event_id")
    table = KeyedTable(t.spark, path, ("user_id", "event_type"), e.schema, buckets=8)
    middle = e.agg((F.max("event_id") / 2).alias("m")).scalar()
    table.insert_only(e.where(F.col("event_id") < middle), [F.asc("event_id")])
    table.insert_only(e, [F.asc("event_id")])
    return table.read()


@query(
    "s15_upsert_by_key",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'CLOSED' ELSE o_orderstatus END AS status FROM orders""",
)
def s15(t):
    path = scratch(t.spark, "upsert")
    o = t.raw("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    table = KeyedTable(t.spark, path, ("o_orderkey",), o.schema, buckets=8)
    table.upsert(o.where(F.col("status") != "P"))
    table.upsert(
        o.where(F.col("status") != "F").withColumn("status", F.when(F.col("status") == "O", "CLOSED").otherwise(F.col("status")))
    )
    return table.read()


@query("s16_append_select", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def s16(t):
    path = scratch(t.spark, "append")
    x = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    flag = F.coalesce("l_returnflag", F.lit(""))
    for part in (flag == "A", flag == "N", ~flag.isin("A", "N")):
        x.where(part).drop("l_returnflag").write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


@query("s17_insert_if_absent", "SELECT n_name, n_regionkey FROM nation")
def s17(t):
    path = scratch(t.spark, "seed")
    n = t.raw("nation").select("n_name", "n_regionkey")
    sinks.insert_if_empty(t.spark, path, n)
    sinks.insert_if_empty(t.spark, path, n)
    return sinks.read_current(t.spark, path)


@query(
    "s18_inline_rows",
    """SELECT account_id, v.rank FROM accounts JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2)) v(kind, rank)
       ON account_type = v.kind""",
)
def s18(t):
    v = t.spark.sql("SELECT * FROM VALUES ('1-URGENT', 1), ('2-HIGH', 2) AS v(account_type, rank)")
    return t.accounts().join(v, "account_type").select("account_id", "rank")


@query("s19_save_as_table", "SELECT customer_segment, COUNT(*) AS n FROM c360 GROUP BY customer_segment")
def s19(t):
    path = scratch(t.spark, "saved")
    for _ in range(2):  # saving again replaces
        build.c360(t).select("customer_id", "customer_segment").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path).groupBy("customer_segment").agg(F.count("*").alias("n"))


@query("s20_create_table_as", "SELECT p_type, COUNT(*) AS n FROM part GROUP BY p_type")
def s20(t):
    path = scratch(t.spark, "ctas")
    t.raw("part").groupBy("p_type").agg(F.count("*").alias("n")).write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "s22_column_defaults",
    """SELECT event_id, COALESCE(CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id END, 0) AS user_id, FALSE AS reviewed
       FROM events""",
)
def s22(t):
    i = F.col("event_id")
    e = t.raw("events").select("event_id", F.when(i % 31 != 0, F.col("user_id")).alias("user_id"))
    return files.with_defaults(e, {"user_id": 0, "reviewed": False})


@query("s23_truncate_and_reload", "SELECT doc_id, lang FROM documents WHERE lang = 'en'")
def s23(t):
    path = scratch(t.spark, "reload")
    d = t.raw("documents").select("doc_id", "lang")
    d.write.parquet(path)
    d.where(F.col("lang") == "en").write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("s24_csv_sink", "SELECT c_custkey, c_name, c_mktsegment, CAST(c_acctbal AS VARCHAR) AS balance FROM customer")
def s24(t):
    path = scratch(t.spark, "csv-out")
    c = t.raw("customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("string").alias("balance"))
    files.write_csv(c, path)
    schema = "c_custkey bigint, c_name string, c_mktsegment string, balance string"
    good, _ = files.typed_or_rejected(files.read_csv_text(t.spark, path, schema), schema)
    return good.select("c_custkey", "c_name", "c_mktsegment", "balance")


@query(
    "s25_bounded_extract",
    """SELECT account_id, CAST(balance AS DOUBLE) AS balance FROM accounts ORDER BY balance DESC, account_id LIMIT 10""",
)
def s25(t):
    top = build.doubles(t.accounts().orderBy(F.desc("balance"), "account_id").limit(10), "balance")
    return t.spark.createDataFrame(top.select("account_id", "balance").toPandas())


@query(
    "s26_mapping_lookup",
    """SELECT ticket_id, n_name AS handled_in FROM tickets JOIN nation ON customer_id % 25 = n_nationkey""",
)
def s26(t):
    from ..operators.joins import broadcast_if_small

    mapping = t.raw("nation").select(F.col("n_nationkey").cast("long").alias("slot"), F.col("n_name").alias("handled_in"))
    x = t.tickets().withColumn("slot", F.col("customer_id") % 25)
    return x.join(broadcast_if_small(mapping), "slot").select("ticket_id", "handled_in")
