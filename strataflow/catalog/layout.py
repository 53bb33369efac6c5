"""Physical layout (C) and the remaining function surfaces."""

from pyspark.sql import functions as F

from ..functions import randoms
from ..functions.compat import dbl_sum
from ..operators import layout, search
from . import build
from .registry import query
from .scratch import scratch


@query("c01_clustered_copy", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2")
def c01(t):
    path = scratch(t.spark, "clustered")
    x = t.raw("lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_extendedprice")
    copy = layout.clustered_copy(x, path, ["l_returnflag", "l_linestatus"], layout.files_for(x, 4))
    return copy.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("c02_clustering_quality", "SELECT TRUE AS as_planned, COUNT(*) AS n_rows, TRUE AS improved FROM lineitem")
def c02(t):
    path = scratch(t.spark, "layout")
    x = t.raw("lineitem").select("l_orderkey", "l_partkey")
    files = layout.files_for(x, 8)
    x.repartition(files).write.parquet(f"{path}/before")
    before = layout.clustering_quality(t.spark.read.parquet(f"{path}/before"), ["l_partkey"])
    after_rows = layout.clustered_copy(x, f"{path}/after", ["l_partkey"], files)
    after = layout.clustering_quality(after_rows, ["l_partkey"])
    from ..operators.reshape import combine_single_rows

    row = combine_single_rows(
        [
            before.select(F.col("avg_overlaps").alias("b")),
            after.select((F.col("n_files") == files).alias("as_planned"), F.col("avg_overlaps").alias("a")),
            after_rows.agg(F.count("*").alias("n_rows")),
        ]
    )
    return row.select("as_planned", "n_rows", (F.col("a") < F.col("b")).alias("improved"))


@query("c03_point_lookup", "SELECT doc_id, lang, source FROM documents WHERE doc_id = 77")
def c03(t):
    d = t.raw("documents").select("doc_id", "lang", "source")
    copy = layout.lookup_copy(d, scratch(t.spark, "lookup"), "doc_id", layout.files_for(d, 2))
    return copy.where(F.col("doc_id") == 77)


@query("c03_substring_search", "SELECT doc_id, lang FROM documents WHERE contains(text, 'and the of')")
def c03b(t):
    d = t.raw("documents")
    found = search.substring_search(d, search.postings(d, "doc_id", "text", ["the"]), "doc_id", "text", "and the of")
    return found.select("doc_id", "lang")


@query(
    "c04_reused_result",
    """SELECT 'type' AS kind, txn_type AS name, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS volume FROM enriched GROUP BY txn_type
       UNION ALL SELECT 'country', customer_country, COUNT(*), CAST(SUM(amount) AS DOUBLE) FROM enriched GROUP BY customer_country""",
)
def c04(t):
    kept = layout.reuse(build.plain_enriched(t).select("txn_type", "customer_country", "amount"))

    def totals(kind, column):
        return kept.groupBy(F.lit(kind).alias("kind"), F.col(column).alias("name")).agg(
            F.count("*").alias("n"), dbl_sum("amount").alias("volume")
        )

    return totals("type", "txn_type").unionByName(totals("country", "customer_country"))


@query(
    "x30_repeatable_random",
    """SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS out_of_range, CAST(10 AS BIGINT) AS distinct_draws, TRUE AS repeatable,
              CAST(3 AS BIGINT) AS sample_size FROM customer""",
)
def x30(t):
    key = "c_custkey"
    draws = t.raw("customer").select(
        randoms.uniform_int(key, "a", 1, 10).alias("i"),
        randoms.uniform_int(key, "a", 1, 10).alias("again"),
        randoms.triangular(key, "t", F.lit(5.0), F.lit(9.0), F.lit(6.0)).alias("tri"),
        F.size(F.array_distinct(randoms.sample_without_replacement(key, "s", ["a", "b", "c", "d", "e"], 3))).alias("k"),
    )
    return draws.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("i").between(1, 10) | ~F.col("tri").between(5, 9)).alias("out_of_range"),
        F.countDistinct("i").alias("distinct_draws"),
        F.bool_and(F.col("i") == F.col("again")).alias("repeatable"),
        F.min("k").cast("long").alias("sample_size"),
    )


@query("x31_sequence_numbers", "SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS seq, o_orderkey FROM orders")
def x31(t):
    from ..operators.windows import dense_ids

    return dense_ids(t.raw("orders").select("o_orderkey"), [F.asc("o_orderkey")], "seq")


@query(
    "x33_session_context",
    """SELECT customer_id, 'analyst_us' AS seen_by, FALSE AS full_access, '***MASKED***' AS email FROM customers
       UNION ALL SELECT customer_id, 'auditor', TRUE, email FROM customers""",
)
def x33(t):
    from ..operators.policy import FULL_ACCESS, SessionContext
    from .policy import ANALYST, registry

    auditor = SessionContext("auditor", frozenset({"COMPLIANCE_OFFICER"}))

    def seen(ctx):
        c = registry().apply(t.customers(), "customers", ctx)
        return c.select(
            "customer_id", F.lit(ctx.user).alias("seen_by"), F.lit(ctx.any_of(FULL_ACCESS)).alias("full_access"), "email"
        )

    return seen(ANALYST).unionByName(seen(auditor))


@query(
    "f04_procedure_status",
    """SELECT 'SUCCESS: segmented ' || CAST(COUNT(DISTINCT customer_id) AS VARCHAR) || ' customers' AS status
       FROM enriched WHERE txn_type = 'DEBIT'""",
)
def f04(t):
    from ..plans.procedures import segment_customers

    result = segment_customers(build.plain_enriched(t), t.customers(), build.as_of(), scratch(t.spark, "rfm"))
    return t.spark.createDataFrame([(result.status,)], "status string")


#: The base tables, by the name of the method and of the SQL view that holds each.
BASE_TABLES = {
    "customers": "customers", "accounts": "accounts", "transactions": "transactions", "tickets": "tickets",
    "risk_assessments": "risk_assessments", "market_data": "market_data", "compliance_documents": "documents",
    "ticket_texts": "conversations",
}


@query(
    "f05_procedure_table",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {view}" for n, view in BASE_TABLES.items()),
)
def f05(t):
    from ..operators.quality import layer_summary

    return layer_summary(t.spark, {n: getattr(t, n)() for n in BASE_TABLES})


@query(
    "f06_metric_function",
    """SELECT 'accounts' AS table_name, 'balance' AS column_name, 'small_balance' AS metric_name,
              CAST(COUNT_IF(balance < 5000) AS BIGINT) AS issue_count FROM accounts""",
)
def f06(t):
    from ..operators.quality import Check, run_checks

    small = Check("small_balance", "accounts", "balance", lambda c: c < 5000)
    return run_checks({"accounts": t.accounts()}, [small], F.lit("now")).drop("measurement_time")
